"""Exact medians of any number of columns by radix selection, with their moments.

A double has a 64-bit image that sorts like it.  Each pass counts, for all columns at once, the
next 16 bits of the values that share the bits found so far; the counters of the tasks are
added up and the bucket that holds the middle rank gives the next bits.  Four passes find any
value exactly, whatever the distribution, and the first one takes count, mean, spread and
ends along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

BITS = 16
PASSES = 64 // BITS
BUCKETS = 1 << BITS
FAN_IN = 1024  # tasks whose moments are merged in the first round
_TOP = np.uint64(1 << 63)

# a mean is a value of the column (near) plus an offset, so that large means lose no digits
_MOMENTS = ("known", "near", "mean", "m2", "low", "high")
_DDL = "c int, slot int, digit int, n long, part int, known long, " + ", ".join(f"{m} double" for m in _MOMENTS[1:])
_SCHEMA = pa.schema(
    [
        ("c", pa.int32()), ("slot", pa.int32()), ("digit", pa.int32()), ("n", pa.int64()), ("part", pa.int32()),
        ("known", pa.int64()), *((m, pa.float64()) for m in _MOMENTS[1:]),
    ]
)
ALL = -1  # the slot of a column's moments


def image(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles; -0 and 0 are one value."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def value(found: int) -> float:
    """The double with that image."""
    bits = np.uint64(found)
    return float((bits ^ _TOP if bits & _TOP else ~bits).reshape(1).view(np.float64)[0])


@dataclass
class Summary:
    """Of one column: rows, known values, their moments, ends and median (None without any)."""

    rows: int = 0
    known: int = 0
    mean: float | None = None
    std: float | None = None
    low: float | None = None
    high: float | None = None
    median: float | None = None


def _counting(p: int, step: int, prefixes: list[list[int]]):
    """Function for mapInArrow: rows of ``p`` doubles in; counters of the next bits out.

    ``prefixes`` are the bits found so far, by column; the first step also gives the moments.
    """
    shift = np.uint64(64 - BITS * (step + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        counts = [[np.zeros(BUCKETS, np.int64) for _ in own] for own in prefixes]
        moments = [(0, 0, 0.0, 0.0, 0.0, math.inf, -math.inf)] * p
        for batch in batches:
            for k in range(p):
                if not prefixes[k]:
                    continue
                x = batch.column(k).to_numpy(zero_copy_only=False).astype(float)
                x = x[~np.isnan(x)]
                if not step:
                    moments[k] = _added(moments[k], x, batch.num_rows)
                images = image(x) >> shift
                for slot, prefix in enumerate(prefixes[k]):
                    own = images[images >> np.uint64(BITS) == np.uint64(prefix)] if step else images
                    counts[k][slot] += np.bincount((own & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        for k in range(p):
            for slot, counted in enumerate(counts[k]):
                digits = np.flatnonzero(counted)
                n = len(digits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, k, np.int32)), pa.array(np.full(n, slot, np.int32)),
                        pa.array(digits.astype(np.int32)), pa.array(counted[digits]), pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.int64()), *[pa.nulls(n, pa.float64()) for _ in _MOMENTS[1:]],
                    ],
                    schema=_SCHEMA,
                )
            if not step:
                rows, *own = moments[k]
                values = [k, ALL, part // FAN_IN, rows, part, *own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(values, _SCHEMA, strict=True)], schema=_SCHEMA
                )

    return run


def _added(held: tuple, x: np.ndarray, rows: int) -> tuple:
    """Moments with one more batch, by the pairwise formula."""
    all_rows, n, near, mean, m2, low, high = held
    if len(x):
        with np.errstate(all="ignore"):
            about = float(x[0]) if np.isfinite(x[0]) else 0.0
            shifted = x - about
            here = float(shifted.mean())
            there = float(((shifted - here) ** 2).sum())
            total = n + len(x)
            if n:
                d = (about - near) + (here - mean)
                mean += d * (len(x) / total)
                m2 += there + d * d * (n * len(x) / total)
            else:
                near, mean, m2 = about, here, there
        n, low, high = total, min(low, float(x.min())), max(high, float(x.max()))
    return all_rows + rows, n, near, mean, m2, low, high


def _merged(a: Column, b: Column) -> Column:
    """Two structs of rows and moments in one."""
    n = a["known"] + b["known"]
    whole = F.greatest(n, F.lit(1)).cast("double")
    apart = (b["near"] - a["near"]) + (b["mean"] - a["mean"])
    d = F.when((a["known"] > 0) & (b["known"] > 0), apart).otherwise(0.0)
    return F.struct(
        (a["rows"] + b["rows"]).alias("rows"),
        n.alias("known"),
        F.when(a["known"] > 0, a["near"]).otherwise(b["near"]).alias("near"),
        F.when(a["known"] > 0, a["mean"] + d * (b["known"] / whole)).otherwise(b["mean"]).alias("mean"),
        (a["m2"] + b["m2"] + d * d * (a["known"] * (b["known"] / whole))).alias("m2"),
        F.least(a["low"], b["low"]).alias("low"),
        F.greatest(a["high"], b["high"]).alias("high"),
    )


_NOTHING = "named_struct('rows', 0L, 'known', 0L, 'near', 0D, 'mean', 0D, 'm2', 0D, 'low', double('inf'), 'high', double('-inf'))"


def _bucket(buckets: Column, rank: Column) -> Column:
    """The digit of the bucket that holds a 0-based rank, and the rank within it."""
    start = F.expr("named_struct('below', 0L, 'digit', -1)")

    def step(state: Column, b: Column) -> Column:
        here = (state["digit"] < 0) & (state["below"] + b["n"] > rank)
        below = state["below"] + F.when((state["digit"] < 0) & ~here, b["n"]).otherwise(F.lit(0).cast("long"))
        return F.struct(below.alias("below"), F.when(here, b["digit"]).otherwise(state["digit"]).alias("digit"))

    return F.aggregate(
        buckets, start, step, lambda s: F.struct(s["digit"].alias("digit"), (rank - s["below"]).alias("rank"))
    )


def _one_pass(df: DataFrame, step: int, prefixes: list[list[int]], ranks: list[list[list[int]]]) -> list:
    """(c, slot, found, moments): the next bits and ranks of each column's slots."""
    rows = df.mapInArrow(_counting(len(df.columns), step, prefixes), _DDL)
    if step:
        wanted = ", ".join(
            f"{2 * c + s}, array({', '.join(f'{x}L' for x in own)})"
            for c, slots in enumerate(ranks) for s, own in enumerate(slots)
        )
        counted = rows.groupBy("c", "slot", "digit").agg(F.sum("n").alias("n"))
        own = counted.groupBy("c", "slot").agg(F.sort_array(F.collect_list(F.struct("digit", "n"))).alias("buckets"))
        found = F.transform(F.expr(f"map({wanted})[2 * c + slot]"), lambda r: _bucket(F.col("buckets"), r))
        return own.select("c", "slot", found.alias("found"), F.lit(None).alias("moments")).collect()
    moment = F.struct("part", F.col("n").alias("rows"), *_MOMENTS)
    counted = rows.groupBy("c", "slot", "digit").agg(
        F.sum("n").alias("n"), F.collect_list(F.when(F.col("slot") == ALL, moment)).alias("parts")
    )
    counted = counted.withColumn(
        "m", F.when(F.col("slot") == ALL, F.aggregate(F.sort_array("parts"), F.expr(_NOTHING), _merged))
    )
    # at most 2 ** 16 buckets of a slot, and one merged moment for every FAN_IN tasks
    own = counted.groupBy("c", "slot").agg(F.sort_array(F.collect_list(F.struct("digit", "n", "m"))).alias("buckets"))
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda t, b: t + b["n"])
    own = own.withColumn("ranks", F.array(F.floor((total - 1) / 2), F.floor(total / 2)))
    found = F.transform("ranks", lambda r: _bucket(F.col("buckets"), r))
    moments = F.aggregate(F.transform("buckets", lambda b: b["m"]), F.expr(_NOTHING), _merged)
    return own.select(
        "c", "slot", F.when(F.col("slot") != ALL, found).alias("found"),
        F.when(F.col("slot") == ALL, moments).alias("moments"),
    ).collect()


def summaries(df: DataFrame, cols: Sequence[Column]) -> list[Summary]:
    """Summary of each numeric column, NaN and NULL counting as missing.  At most four scans.

    What reaches the driver is a few numbers per column.  Infinities are ordinary values.
    """
    p = len(cols)
    numbers = df.select(*[c.cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    out = [Summary() for _ in cols]
    prefixes: list[list[int]] = [[0] for _ in cols]
    ranks: list[list[list[int]]] = [[] for _ in cols]
    ends: list[list[tuple[int, int]]] = [[] for _ in cols]  # bits found and rank left, of both middle ranks
    for step in range(PASSES):
        for c, slot, found, moments in _one_pass(numbers, step, prefixes, ranks):
            if slot == ALL:
                s = out[c]
                s.rows, s.known = moments["rows"], moments["known"]
                if s.known:
                    s.mean, s.low, s.high = moments["near"] + moments["mean"], moments["low"], moments["high"]
                    s.std = math.sqrt(moments["m2"] / (s.known - 1)) if s.known > 1 else None
            else:
                ends[c] += [(prefixes[c][slot] << BITS | f["digit"], f["rank"]) for f in found]
        for c in range(p):
            prefixes[c] = sorted({bits for bits, _ in ends[c]})
            ranks[c] = [sorted({r for bits, r in ends[c] if bits == prefix}) for prefix in prefixes[c]]
        if step < PASSES - 1:
            ends = [[] for _ in cols]
        if not any(prefixes):
            break  # no column has a value
    for c, s in enumerate(out):
        if prefixes[c]:
            low, high = value(prefixes[c][0]), value(prefixes[c][-1])
            large = abs(low) > 1e300 or abs(high) > 1e300
            s.median = low if low == high else low / 2 + high / 2 if large else (low + high) / 2
    return out
