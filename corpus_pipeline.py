"""From raw documents to piece ids: five stages, each written and reread as the next one's input.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of documents.  run() applies them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vintage_panel.llm.common import documents, stored
from vintage_panel.llm.language_id import UNDETERMINED, fit, language_id
from vintage_panel.llm.line_dedup import line_dedup
from vintage_panel.llm.mixing import mix
from vintage_panel.llm.near_dedup import near_dedup
from vintage_panel.llm.sentencepiece_codec import encode, read_model
from vintage_panel.llm.settings import PIECES

#: documents that consist of less of what was seen in their language are in none that the model
#: knows; the score would not do, as it falls with the number of languages
LEAST_KNOWN = 0.5


def _columns(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of ``docs`` out of the struct ``row``, with some replaced."""
    return [new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; ``lang`` becomes the predicted one.

    The model learns from the labels of ``docs`` themselves.  Texts without a letter go.
    """
    found = language_id(docs, fit(docs), known=True)
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("known") >= LEAST_KNOWN))
    return kept.select(*_columns(docs, lang=F.col("lang_pred")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines in repeated three-line windows; emptied documents go."""
    deduped = line_dedup(docs)
    kept = deduped.filter((F.col("n_removed") < F.col("n_lines")) | (F.col("n_removed") == 0))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    return kept.select(*_columns(docs, text=F.col("kept_text"), n_chars=n_chars))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shard by shard."""
    return mix(docs).select("row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text."""
    return encode(docs, read_model(PIECES)).select(
        "row.doc_id",
        "row.lang",
        "row.source",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        "round_trip",
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: no SQL for the language model, the signatures and the pieces
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
