"""Centred co-moments of all pairs of columns in one scan.

A task turns its rows into count, means and centred sums for every pair of columns, as matrix
products over tiles of columns, and merges batch after batch by the pairwise formula, which
keeps small spreads on large means.  Tasks hand on one row per column and tile; these meet
first within groups of tasks, then across groups, one at a time, so no task holds more than
one tile row.  Beyond ``HELD`` bytes of tiles a task hands on those of each batch instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

TILE = 64  # columns
FAN_IN = 1024  # tasks whose tiles meet in the first round
HELD = 256 << 20

# per pair (x, y) over the rows where both are known.  A mean is a value of the column (a) plus a small
# offset (m), so that means far from 0 lose no digits.  q: sums of squares about the batch medians,
# which bound the rounding of what is centred out of them
SUMS = ("n", "ax", "ay", "mx", "my", "sxx", "syy", "sxy", "qx", "qy")
_N, _AX, _AY, _MX, _MY, _SXX, _SYY, _SXY, _QX, _QY = range(len(SUMS))
_DDL = "i int, b int, part int, " + ", ".join(f"{s} array<double>" for s in SUMS)
_SCHEMA = pa.schema(
    [("i", pa.int32()), ("b", pa.int32()), ("part", pa.int32()), *((s, pa.list_(pa.float64())) for s in SUMS)]
)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together; the first axis runs over SUMS."""
    n = a[_N] + b[_N]
    whole = np.where(n > 0, n, 1.0)
    first, both = a[_N] > 0, (a[_N] > 0) & (b[_N] > 0)
    dx = np.where(both, (b[_AX] - a[_AX]) + (b[_MX] - a[_MX]), 0.0)
    dy = np.where(both, (b[_AY] - a[_AY]) + (b[_MY] - a[_MY]), 0.0)
    weight, share = a[_N] * b[_N] / whole, b[_N] / whole
    return np.stack(
        [
            n,
            np.where(first, a[_AX], b[_AX]),
            np.where(first, a[_AY], b[_AY]),
            np.where(first, a[_MX] + dx * share, b[_MX]),
            np.where(first, a[_MY] + dy * share, b[_MY]),
            a[_SXX] + b[_SXX] + dx * dx * weight,
            a[_SYY] + b[_SYY] + dy * dy * weight,
            a[_SXY] + b[_SXY] + dx * dy * weight,
            a[_QX] + b[_QX],
            a[_QY] + b[_QY],
        ]
    )


class _Columns:
    """One batch's tile of columns: shifted values, 0 where unknown, and what is known."""

    def __init__(self, batch: pa.RecordBatch, start: int, stop: int) -> None:
        raw = np.column_stack(
            [batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(start, stop)]
        )
        known = ~np.isnan(raw)
        self.infinite = np.isinf(raw).any()
        with np.errstate(invalid="ignore"):
            inside = np.isfinite(raw)
        self.pivot = np.array([np.median(c[m]) if m.any() else 0.0 for c, m in zip(raw.T, inside.T)])
        shifted = np.where(inside, raw - self.pivot, 0.0)
        self.known, self.x, self.xx = known.astype(float), shifted, shifted * shifted
        self.endless = (known & ~inside).astype(float)

    def with_(self, other: _Columns) -> np.ndarray:
        """Moments of these columns (rows) with others (columns)."""
        n = self.known.T @ other.known
        rows = np.where(n > 0, n, 1.0)
        sx, sy = self.x.T @ other.known, self.known.T @ other.x
        qx, qy = self.xx.T @ other.known, self.known.T @ other.xx
        sxy = self.x.T @ other.x
        if self.infinite or other.infinite:  # pairs that meet an infinity have no correlation
            met = (self.endless.T @ other.known) + (self.known.T @ other.endless) > 0
            qx = np.where(met, np.inf, qx)
        ax, ay = np.broadcast_arrays(self.pivot[:, None], other.pivot[None, :])
        sxx = np.maximum(np.where(np.isinf(qx), 0.0, qx) - sx * sx / rows, 0.0)
        syy = np.maximum(qy - sy * sy / rows, 0.0)
        return np.stack([n, ax, ay, sx / rows, sy / rows, sxx, syy, sxy - sx * sy / rows, qx, qy])


def _emitted(a: int, b: int, part: int, sums: np.ndarray) -> pa.RecordBatch:
    """One row per column of tile ``a`` with its moments against tile ``b``, filled up to TILE."""
    rows = sums.shape[1]
    full = np.zeros((len(SUMS), rows, TILE))
    full[:, :, : sums.shape[2]] = sums
    ends = pa.array(np.arange(0, rows * TILE + 1, TILE, dtype=np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(m.reshape(-1))) for m in full]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(a, a + rows, dtype=np.int32)), pa.array(np.full(rows, b, np.int32)),
            pa.array(np.full(rows, part, np.int32)), *lists,
        ],
        schema=_SCHEMA,
    )


def _of_rows(p: int, tile: int, held: int):
    """Function for mapInArrow: rows of ``p`` numbers in, tile rows out."""
    starts = range(0, p, tile)
    pairs = [(a, b) for a in starts for b in starts if a <= b]
    gather = len(pairs) * tile * tile * 8 * len(SUMS) <= held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        width = {a: min(tile, p - a) for a in starts}
        sums = {(a, b): np.zeros((len(SUMS), width[a], width[b])) for a, b in pairs} if gather else {}
        for batch in batches:
            tiles = {a: _Columns(batch, a, a + width[a]) for a in starts}
            for a, b in pairs:
                found = tiles[a].with_(tiles[b])
                if gather:
                    sums[a, b] = merged(sums[a, b], found)
                else:
                    yield _emitted(a, b, part, found)
        for a, b in pairs:
            yield _emitted(a, b, part, sums[a, b] if gather else np.zeros((len(SUMS), width[a], width[b])))

    return run


def _merging(fan_in: int):
    """Function for mapInArrow: sorted tile rows in; those of one column, tile and group of parts in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        out: list[tuple] = []

        def closed() -> pa.RecordBatch:
            keys = np.array([k for k, _ in out], np.int32)
            sums = np.stack([s for _, s in out], axis=1)
            ends = pa.array(np.arange(0, len(out) * TILE + 1, TILE, dtype=np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(m).reshape(-1))) for m in sums]
            return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in keys.T), *lists], schema=_SCHEMA)

        for batch in batches:
            i, b, part = (batch.column(k).to_numpy() for k in range(3))
            sums = np.stack([batch.column(k + 3).flatten().to_numpy().reshape(-1, TILE) for k in range(len(SUMS))])
            for r in range(len(i)):
                now = (int(i[r]), int(b[r]), int(part[r]) // fan_in)
                if now == key:
                    held = merged(held, sums[:, r])
                    continue
                if key is not None:
                    out.append((key, held))
                key, held = now, sums[:, r]
                if len(out) >= 2_000:
                    yield closed()
                    out = []
        if key is not None:
            out.append((key, held))
            yield closed()

    return run


def pair_moments(df: DataFrame, tile: int = TILE, held: int = HELD, fan_in: int = FAN_IN) -> DataFrame:
    """(i, j, and SUMS) for every pair i < j of the numeric columns of ``df``, by position.

    One scan.  NULL and NaN are unknown; a pair that meets an infinity has an infinite ``qx``.
    """
    if not 0 < tile <= TILE:
        raise ValueError(f"tile must lie within 1..{TILE}")
    parts = df.mapInArrow(_of_rows(len(df.columns), tile, held), _DDL)
    group = F.floor(F.col("part") / fan_in).cast("int")
    near = (
        parts.repartition("i", "b", group).sortWithinPartitions("i", "b", "part").mapInArrow(_merging(fan_in), _DDL)
    )
    whole = near.repartition("i", "b").sortWithinPartitions("i", "b", "part").mapInArrow(_merging(1 << 31), _DDL)
    return (
        whole.select("i", "b", F.posexplode(F.arrays_zip(*SUMS)).alias("k", "m"))
        .select("i", (F.col("b") + F.col("k")).alias("j"), "k", "m.*")
        .filter((F.col("j") > F.col("i")) & (F.col("k") < tile) & (F.col("j") < len(df.columns)))
        .drop("k")
    )
