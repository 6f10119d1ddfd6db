"""Left joins that stay balanced when one key holds a large part of the rows.

Aggregations need no help: Spark combines on the map side, so a hot key sends one row per
map task.  A left join does: all rows of a key meet in one task.  AQE can split such a task
for the first join after a shuffle only, so joins on an account or application key go
through :func:`lookup_join`, and joins to many rows per key through :func:`expanding_join`.

What counts as hot follows from the rows that one task shall take, not from a share of the
table, and a hot key is spread over as many tasks as it fills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

ROWS_PER_TASK = 2_000_000

# for tables that hold one row per key by construction
NO_HOT_KEYS: tuple = ()
# for tables stored in buckets of the key: the key itself is joined, so no rows move
CO_LOCATED: tuple = ("co-located",)


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than a task shall take, and over how many tasks to spread them.

    A lazy aggregate of the key column, combined on the map side.  It has fewer rows than
    tasks of ``rows_per_task`` rows are needed for the table, whatever the keys.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__hot")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    return counts.filter(F.col("__n") > rows_per_task).select(
        "__hot", F.ceil(F.col("__n") / rows_per_task).cast("int").alias("__salts")
    )


def _row_hash(df: DataFrame) -> Column:
    """The same in a rerun of a lost task."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _stand_in(df: DataFrame, on: str) -> Column | None:
    """For a NULL key, a value of the key's type that differs from row to row."""
    dtype = df.schema[on].dataType
    if isinstance(dtype, T.StringType):
        return _row_hash(df).cast("string")
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.pmod(_row_hash(df), F.lit(2**31 - 1)).cast(dtype)
    return None


def _salted(df: DataFrame, on: str, hot: DataFrame) -> DataFrame:
    """``df`` with ``__salt``: 0, or one of the salts of a hot key by a hash of the row."""
    known = df.join(F.broadcast(hot), F.col(on) == F.col("__hot"), "left")
    salt = F.pmod(_row_hash(df), F.coalesce("__salts", F.lit(1))).cast("int")
    return known.withColumn("__salt", salt).drop("__hot", "__salts")


def _copied(df: DataFrame, on: str, hot: DataFrame) -> DataFrame:
    """``df`` once per salt of its key."""
    known = df.join(F.broadcast(hot), F.col(on) == F.col("__hot"), "left")
    salts = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
    return known.withColumn("__salt", F.explode(salts)).drop("__hot", "__salts")


def lookup_join(
    left: DataFrame, right: DataFrame, on: str, *, hot: DataFrame | tuple | None = None
) -> DataFrame:
    """``left`` left-joined to ``right``; rows of hot keys and without a key are spread.

    ``hot`` is what :func:`hot_keys` gives; by default it is taken from ``left``.  Pass the
    hot keys of the raw table where ``left`` is costly to compute, or :data:`NO_HOT_KEYS`
    where it is unique by ``on``, :data:`CO_LOCATED` where both sides are stored in buckets of it and have
    no hot keys.  Rows of a hot key get a salt and the matching right rows
    are copied once per salt.  Left rows without a key match nothing; they get a stand-in
    key each, under a condition that keeps it from matching.  Nothing runs here.
    """
    if isinstance(hot, tuple) and hot == CO_LOCATED:
        rest = [c for c in right.columns if c != on]
        first = [on, *[c for c in left.columns if c != on]]
        return left.join(right, on, "left").select(*[F.col(f"`{c}`") for c in [*first, *rest]])
    stand_in = _stand_in(left, on)
    keyed = left.withColumn("__key", F.col(on) if stand_in is None else F.coalesce(on, stand_in))
    other = right.withColumnRenamed(on, "__right")
    match = (F.col("__key") == F.col("__right")) & F.col(on).isNotNull()
    if not isinstance(hot, tuple):
        hot = hot_keys(left, on) if hot is None else hot
        keyed = _salted(keyed, on, hot)
        other = _copied(other, "__right", hot).withColumnRenamed("__salt", "__copy")
        match = match & (F.col("__salt") == F.col("__copy"))
    rest = [F.col(f"`{c}`") for c in right.columns if c != on]
    first = [F.col(on), *[F.col(f"`{c}`") for c in left.columns if c != on]]
    return keyed.join(other, match, "left").select(*first, *rest)


def expanding_join(
    left: DataFrame, right: DataFrame, on: str, *, hot: DataFrame | None = None
) -> DataFrame:
    """``left`` (few rows per key) left-joined to ``right`` (many): hot keys of ``right`` are spread.

    The right rows get the salts and the left rows the copies.  A copy without a partner must
    not look like a row without one, so left rows whose key ``right`` lacks are added apart.
    """
    hot = hot_keys(right, on) if hot is None else hot
    met = _copied(left, on, hot).join(_salted(right, on, hot), [on, "__salt"]).drop("__salt")
    absent = left.join(right.select(on).filter(F.col(on).isNotNull()).distinct(), on, "left_anti")
    return met.unionByName(absent, allowMissingColumns=True).select(*met.columns)
