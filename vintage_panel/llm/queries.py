"""Checked queries of the document operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline

from .common import documents
from .conversations import damage, repair
from .exact_dedup import exact_dedup
from .filter_audit import filter_audit
from .language_id import fit, language_id
from .licenses import fit_scan, scan_licenses
from .line_dedup import line_dedup
from .mixing import mixed_sizes
from .near_dedup import near_groups
from .oracles import ORACLES
from .pii import find_pii
from .quality import quality

from .sentencepiece_codec import encode, read_model

from .settings import PIECES
from .suffix_dedup import suffix_dedup
from .toxicity import score_documents

__all__ = ["ORACLES", "QUERIES"]


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(documents(spark, sf_dir)).drop("source")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup(documents(spark, sf_dir))
    return deduped.select(
        "row.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(documents(spark, sf_dir).select("doc_id", "text"), read_model(PIECES))
    return encoded.select("row.doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan_licenses(docs, *fit_scan(docs))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = fit(docs.filter(~F.coalesce(held_out, F.lit(False))))
    return language_id(docs, model).select(
        "row.doc_id",
        (F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out"),
        "lang_pred",
        "score",
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damage(turns), turns)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    scored = score_documents(docs, labels, held_out)
    return scored.select("row.doc_id", "score", "predicted").withColumn("held_out", held_out)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix,
        op2_exact_dedup,
        op3_pii,
        op4_line_dedup,
        op5_sentencepiece,
        op6_licenses,
        op7_suffix_dedup,
        op8_near_dedup,
        op9_language_id,
        op10_quality,
        op11_filter_audit,
        op12_conversation_repair,
        op13_toxicity,
        pipeline,
    )
}
