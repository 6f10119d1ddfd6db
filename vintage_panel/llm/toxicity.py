"""Toxicity of texts whose disguised words have been restored.

Texts are restored first (see ``deobfuscate``).  A logistic regression with an L1 penalty, fitted by Spark
on a bounded sample of labelled rows, then weighs the distinct words of the restored text and their
beginnings, so that one offending word among thousands counts and inflected forms of it do too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .deobfuscate import Restorer, language_model

SAMPLE = 20_000  # labelled rows of each class, about, that the classifier is fitted on
TERMS = 50_000  # words and beginnings that the classifier may weigh, those most tied to the label
MIN_TOXIC = 3  # toxic documents of the sample that a term stands in
MIN_LIFT = 2.0  # times as frequent among toxic documents as among the others
PENALTY = 0.5  # documents' worth of evidence that a term must exceed; divided by the rows of the sample
STEPS = 100
STARTS = (3, 4, 5, 6)  # letters of a word's beginnings
BROADCAST_ROWS = 200_000  # rows of the sample whose ids are broadcast
KEPT_WORDS = 200_000  # weights of words that a task remembers at a time

LETTERS = re.compile(r"[^\W\d_]+")


def terms(word: str) -> list[str]:
    """What the classifier sees of a word: itself and its beginnings."""
    return [word, *[f"{word[:n]}-" for n in STARTS if len(word) >= n]]


@dataclass
class Model:
    """Costs of the character model, weights of terms and the score of a text without any."""

    costs: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0


class Scorer:
    """Scores texts by a model; remembers the weights of words, a bounded number at a time."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.restore = Restorer(model.costs)
        self.known: dict[str, float] = {}

    def words(self, text: str | None) -> set[str]:
        return set(LETTERS.findall(self.restore(text)))

    def __call__(self, text: str | None) -> float:
        words = self.words(text)
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        weights = self.model.weights
        for word in words.difference(self.known):
            self.known[word] = sum(weights.get(t, 0.0) for t in terms(word))
        total = self.model.intercept + math.fsum(map(self.known.__getitem__, words))
        return 1 / (1 + math.exp(-total)) if total > -700 else 0.0


def _draw(text: Column) -> Column:
    return F.pmod(F.xxhash64(text, F.lit("toxicity sample")), F.lit(1 << 31))


def _chosen(rows: DataFrame) -> DataFrame:
    """Rows that belong to the sample, about SAMPLE of each class; ``rows`` has label and draw."""
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two classes
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, SAMPLE / n)).otherwise(share)
    return rows.filter(F.col("draw") < share * (1 << 31))


def drawn(docs: DataFrame, marks: DataFrame, text_col: str = "text") -> DataFrame:
    """(text, label) of about SAMPLE rows of each class, by a hash of the text.

    ``docs`` has doc_id and a text, ``marks`` doc_id and a 0/1 label ``toxic``, once per id.  Labels meet ids and
    hashes only; texts are looked up by the ids of the sample, so no other text is moved.
    """
    label = (F.col("toxic") == 1).cast("int").alias("label")
    met = docs.filter(F.col(text_col).isNotNull()).select("doc_id", _draw(F.col(text_col)).alias("draw"))
    rows = met.join(marks.select("doc_id", label).filter(F.col("label").isNotNull()), "doc_id")
    picked = stored(_chosen(rows).distinct())
    if picked.count() <= BROADCAST_ROWS:  # copies of one text are drawn together and may be many
        picked = F.broadcast(picked)
    texts = docs.select("doc_id", F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    texts = texts.withColumn("draw", _draw(F.col("text")))
    return texts.join(picked, ["doc_id", "draw"]).select("text", "label")


def fit(labelled: DataFrame, costs: np.ndarray, text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model of rows with a text and a 0/1 label; rows without either teach nothing.

    Without two classes, or without a term tied to the label, every text gets the share of
    toxic rows (0 for none).
    """
    rows = labelled.select(F.col(text_col).alias("text"), (F.col(label_col) == 1).cast("int").alias("label"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("label").isNotNull())
    return fit_sample(_chosen(rows.withColumn("draw", _draw(F.col("text")))), costs)


def fit_sample(sample: DataFrame, costs: np.ndarray) -> Model:
    """The model of the rows (text, label) of a bounded sample; see :func:`fit`."""
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast(costs)  # 28 ** 4 numbers

    def seen(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(Model(shared.value))
        for batch in texts:
            yield pd.Series([sorted({t for w in scorer.words(x) for t in terms(w)}) for x in batch])

    found = F.pandas_udf(seen, "array<string>")
    sample = stored(sample.select("label", found("text").alias("terms")))
    by_label = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = by_label.get(1, 0), by_label.get(0, 0)
    share = toxic / max(toxic + clean, 1)
    plain = Model(costs, {}, math.log(share / (1 - share)) if 0 < share < 1 else 30.0 if share else -30.0)
    if not toxic or not clean:
        return plain
    counts = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count_if(F.col("label") == 1).alias("n1"), F.count_if(F.col("label") == 0).alias("n0")
    )
    # the log likelihood ratio of standing in toxic documents against the chance share
    expected = (F.col("n1") + F.col("n0")) * share
    tied = F.col("n1") * F.log(F.col("n1") / expected)
    lift = F.col("n1") / toxic > MIN_LIFT * F.col("n0") / clean
    vocabulary = [
        r["term"]
        for r in counts.filter((F.col("n1") >= min(MIN_TOXIC, toxic)) & lift)
        .orderBy(tied.desc(), "term").limit(TERMS).select("term").collect()
    ]
    if not vocabulary:
        return plain
    counter = CountVectorizerModel.from_vocabulary(vocabulary, "terms", "features")
    features = counter.transform(sample).select(F.col("label").cast("double").alias("label"), "features")
    regression = LogisticRegression(
        regParam=PENALTY / (toxic + clean), elasticNetParam=1.0, standardization=False, maxIter=STEPS, tol=1e-5
    ).fit(features.coalesce(8).cache())
    values = regression.coefficients.toArray()
    weights = {vocabulary[i]: float(values[i]) for i in np.flatnonzero(values)}
    return Model(costs, weights, float(regression.intercept))


def toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` in a struct ``row``, with score (0 to 1) and predicted (1 from 0.5 on).

    Only the text is looked at, all of it.  NULL and empty texts get the score of a text without
    words.  Repeated rows get the same score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 28 ** 4 numbers and at most TERMS weights

    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in texts:
            yield pd.Series([scorer(x) for x in batch], dtype="float64")

    # nondeterministic to the optimiser: it must not copy the call into a filter on the score
    score = F.pandas_udf(scored, "double").asNondeterministic()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), score(F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score_documents(docs: DataFrame, labels: DataFrame, held_out=None) -> DataFrame:
    """:func:`toxicity` of ``docs``, learned from ``labels`` (doc_id, toxic) on rows not ``held_out``.

    A document with several labels is toxic if one says so; labels and documents with a NULL id do
    not meet.  The character model is counted on all of ``docs``.
    """
    costs = language_model(docs)
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learned = docs.select("doc_id", "text") if held_out is None else docs.select("doc_id", "text").filter(~held_out)
    return toxicity(docs, fit_sample(drawn(learned, marks), costs))
