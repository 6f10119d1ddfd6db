"""Interaction audit of quality filters on sorted posting lists.

Each filter keeps, per part and range of ids, the sorted list of the documents that fail it.
What a filter removes after others have run is the difference of its list and theirs; what
others leave is the range without the union of their lists.  Differences and unions are taken
by galloping merges range by range, only their sizes are summed, and every order of the
filters is read off these sums.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import partitions, stored

FILTERS = "ABCDE"
RANGE = 65_536  # documents of one part in one range of ids: the bound of every list

LEAST_WORDS = 200
LEAST_DISTINCT = 50  # per cent of the words
MOST_CAPITALS = 3  # per cent of the code points
SYMBOLS = re.compile(r"[#$%&*|]")
CAPITALS = re.compile(rb"[^A-Z]+")


# ---------------------------------------------------------------- what fails
def _failures(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # bytes part at ASCII white space alone
    capitals = len(CAPITALS.sub(b"", raw))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * len(text)) << 2
        | bool(SYMBOLS.search(text)) << 3
    )


def _examined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("part"),
                pa.array([_failures(t) for t in texts], pa.int32()),
                pa.array([hashlib.sha256(t.encode("utf-8", "replace")).digest() for t in texts], pa.binary()),
            ],
            names=["id", "part", "fails", "digest"],
        )


def failed_filters(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """(id, place, part, fails) per row of ``docs``: bit k is set if it fails the k-th of FILTERS.

    A: under 200 words.  B: distinct words under 50 % of the words.  C: A-Z over 3 % of the
    code points.  D: holds one of ``#$%&*|``.  E: the same text as a row with a smaller id,
    in any part, compared by SHA-256 of the whole text.  A NULL text counts as empty, a NULL
    part as the empty string; a NULL id is smaller than none and larger than none.
    ``place`` tells rows apart that repeat an id.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.col(text_col).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    seen = rows.mapInArrow(_examined, f"id {kind}, part string, fails int, digest binary")
    seen = stored(seen.withColumn("place", F.monotonically_increasing_id()))
    first = seen.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    # rows of a text that stands once need no partner
    again = seen.join(first.filter("copies > 1"), "digest", "left")
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int")
    return again.select("id", "place", "part", (F.col("fails") + copy * 16).alias("fails"))


# ---------------------------------------------------------------- posting lists
def posting_lists(
    rows: DataFrame, filters: str = FILTERS, marks: Sequence[str] = (), size: int = RANGE, n_partitions: int | None = None
) -> DataFrame:
    """(part, n, lists): one row per part and range of at most ``size`` documents.

    ``rows`` holds id, place, part, fails and 0/1 columns ``marks``.  ``lists`` has the sorted list of
    the failing documents of each filter, then those with each mark.  A document is named by its
    place in its range, which follows the ids, so repeated and NULL ids stay apart.  Ranges are
    cut by part and id together: a part with most of the rows spreads over all tasks.
    """
    n_lists = len(filters) + len(marks)
    schema = pa.schema(
        [("part", pa.string()), ("n", pa.int64()), ("lists", pa.list_(pa.list_(pa.int32())))]
    )

    def listed(part: str, bits: np.ndarray) -> pa.RecordBatch:
        lists = [np.flatnonzero(bits >> k & 1).astype(np.int32) for k in range(n_lists)]
        return pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([len(bits)], pa.int64()), pa.array([lists], schema.field("lists").type)],
            schema=schema,
        )

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting = None, np.empty(0, np.int64)
        for batch in batches:
            names, bits = batch.column("part").to_pylist(), batch.column("bits").to_numpy()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if names[a] != part:
                    if len(waiting):
                        yield listed(part, waiting)
                    part, waiting = names[a], waiting[:0]
                waiting = np.concatenate([waiting, bits[a:b]])
                while len(waiting) >= size:
                    yield listed(part, waiting[:size])
                    waiting = waiting[size:]
        if len(waiting):
            yield listed(part, waiting)

    bits = F.col("fails").cast("long")
    for k, mark in enumerate(marks, len(filters)):
        bits = bits + F.coalesce(F.col(mark), F.lit(0)).cast("long") * (1 << k)
    n = n_partitions or partitions(rows.sparkSession)
    return (
        rows.select("part", "id", "place", bits.alias("bits"))
        .repartitionByRange(n, "part", "id", "place")
        .sortWithinPartitions("part", "id", "place")
        .select("part", "bits")
        .mapInArrow(mapped, "part string, n long, lists array<array<int>>")
    )


def difference(ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sorted ``ids`` that the sorted ``other`` lacks.

    Gallops: jumps to the stretch of ``other`` that ``ids`` span, then each member of the
    shorter list leaps into the longer one by binary search, so the runs between are skipped.
    """
    if not len(ids) or not len(other):
        return ids
    other = other[np.searchsorted(other, ids[0]) : np.searchsorted(other, ids[-1], "right")]
    if not len(other):
        return ids
    if len(other) < len(ids):
        at = np.searchsorted(ids, other)
        keep = np.ones(len(ids), bool)
        keep[at[ids[at] == other]] = False  # other ends within ids, so every place is one
        return ids[keep]
    at = np.searchsorted(other, ids)
    return ids[(at == len(other)) | (other[np.minimum(at, len(other) - 1)] != ids)]


def common(ids: np.ndarray, other: np.ndarray) -> int:
    """How many ids two sorted lists share."""
    return len(ids) - len(difference(ids, other))


def left_over(lists: Sequence[np.ndarray]) -> dict[tuple[int, int], np.ndarray]:
    """(k, set of other lists as bits) -> what list k holds that none of these holds.

    Each is one merge from the difference with one list less, so every k-way difference is
    shared by the orders that need it.
    """
    out: dict[tuple[int, int], np.ndarray] = {}
    for k, ids in enumerate(lists):
        out[k, 0] = ids
        for others in range(1, 1 << len(lists)):
            if not others >> k & 1:
                top = others.bit_length() - 1
                out[k, others] = difference(out[k, others ^ 1 << top], lists[top])
    return out


def interactions(postings: DataFrame, n_filters: int = len(FILTERS), n_marks: int = 0) -> DataFrame:
    """(part, k, others, n, failing, removed, marked): sums over the ranges of each part.

    ``n`` documents, ``failing`` filter k, ``removed`` of these by none of ``others`` (bits), and of the
    removed those with each mark.
    """
    fields = [("part", pa.string()), ("k", pa.int32()), ("others", pa.int32())]
    sums = ["n", "failing", "removed", *(f"marked_{m}" for m in range(n_marks))]
    schema = pa.schema(fields + [(s, pa.int64()) for s in sums])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, n, lists in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lists = [np.asarray(x, np.int32) for x in lists]
                fails, marks = lists[:n_filters], lists[n_filters:]
                for (k, others), ids in left_over(fails).items():
                    rows.append((part, k, others, n, len(fails[k]), len(ids), *(common(m, ids) for m in marks)))
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    ddl = "part string, k int, others int, " + ", ".join(f"{s} long" for s in sums)
    counted = postings.mapInArrow(mapped, ddl)
    return counted.groupBy("part", "k", "others").agg(*[F.sum(s).alias(s) for s in sums])


# ---------------------------------------------------------------- orders
def audit_orders(sums: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part and order of the filters a row for each step, from :func:`interactions`.

    kept after the step, removed by it, redundant (failing but removed earlier), unique_fails
    (failing this filter alone), marks lost, and shapley (removed by the filter, over all orders).
    """
    spark, n = sums.sparkSession, len(filters)
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, k in enumerate(order, 1):
            steps.append(("".join(filters[x] for x in order), step, k, before))
            before |= 1 << k
    orders = spark.createDataFrame(steps, "filter_order string, step int, k int, others int")
    size = F.bit_count("others")
    weight = F.element_at(  # orders in which exactly these filters run before
        F.array(*[F.lit(factorial(s) * factorial(n - 1 - s)) for s in range(n)]), (size + 1).cast("int")
    )
    by_filter = sums.groupBy("part", "k").agg(
        F.sum(F.col("removed") * weight).cast("long").alias("shapley"),
        F.sum(F.when(size == n - 1, F.col("removed"))).alias("unique_fails"),
    )
    table = sums.join(by_filter, ["part", "k"]).join(F.broadcast(orders), ["k", "others"])  # n! * n rows
    # what the steps so far have removed is the union of their lists
    so_far = F.sum("removed").over(
        Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    )
    marked = [c for c in sums.columns if c.startswith("marked_")]
    return table.select(
        "part", "filter_order", "step", (F.col("n") - so_far).alias("kept"), "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", *marked, "shapley",
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does in each order, per part (``lang``; NULL: empty string).

    ``labels`` (doc_id, quality, toxic) marks the good and the toxic documents; a document with several
    label rows has a mark if one of them has it, rows with a NULL id mark none.  Every row of
    ``docs`` counts, repeated ones too.  No documents give no rows.
    """
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    )
    rows = failed_filters(docs).join(marks, "id", "left")
    sums = stored(interactions(posting_lists(rows, marks=["good", "toxic"]), n_marks=2))
    return audit_orders(sums).withColumnsRenamed({"marked_0": "good_lost", "marked_1": "toxic_lost"})

