"""Weight of evidence and information value of categorical features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from .screening import _q, low_cardinality, string_columns

MISSING = "Missing"
MAX_LEVELS = 50


def candidates(df: DataFrame, target: str) -> list[str]:
    return [c for c in string_columns(df) if c != target]


def level_counts(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Rows and bads per (feature, level), all features in one pass."""
    long = df.select(
        _q(target).alias("__y"),
        *[F.coalesce(_q(c).cast("string"), F.lit(MISSING)).alias(c) for c in features],
    ).unpivot(["__y"], [_q(c) for c in features], "feature", "level")
    counts = long.groupBy("feature", "level").agg(
        F.count("__y").alias("total"), F.coalesce(F.sum("__y"), F.lit(0)).alias("bad")
    )
    return counts.withColumn("good", F.col("total") - F.col("bad"))


def woe_table(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """WoE and IV part per (feature, level).

    A feature with one outcome class only has no WoE (NULL) and IV 0.  Totals per feature
    come from an aggregate rather than a window, so a feature with many levels is not
    gathered in one task; they hold one row per feature and are broadcast.
    """
    if not features:
        return df.sparkSession.createDataFrame(
            [],
            "feature string, level string, total bigint, bad bigint, good bigint, "
            "dist_good double, dist_bad double, woe double, iv double",
        )
    counts = level_counts(df, features, target)
    totals = counts.groupBy("feature").agg(
        F.sum("bad").alias("__bad"), F.sum("good").alias("__good")
    )
    both = (F.col("__bad") != 0) & (F.col("__good") != 0)
    good = F.when(both, (F.col("good") + F.lit(0.5)) / F.nullif("__good", F.lit(0)))
    bad = F.when(both, (F.col("bad") + F.lit(0.5)) / F.nullif("__bad", F.lit(0)))
    return (
        counts.join(F.broadcast(totals), "feature")
        .select(
            "feature", "level", "total", "bad", "good",
            good.alias("dist_good"), bad.alias("dist_bad"),
        )
        .withColumn("woe", F.ln(F.col("dist_good") / F.col("dist_bad")))
        .withColumn(
            "iv",
            F.coalesce((F.col("dist_good") - F.col("dist_bad")) * F.col("woe"), F.lit(0.0)),
        )
    )


def strength(iv: Column) -> Column:
    limit, label = codes.IV_WEAK
    out = None
    for cut, name in codes.IV_STRENGTH:
        out = F.when(iv > cut, name) if out is None else out.when(iv > cut, name)
    return out.when(iv >= limit, label).otherwise(codes.IV_USELESS)


def eligible(
    df: DataFrame, target: str, ignore: Sequence[str] = (), max_levels: int = MAX_LEVELS
) -> list[str]:
    """Categorical features not ignored (any case) with at most ``max_levels`` values."""
    skip = {c.upper() for c in ignore}
    cols = [c for c in candidates(df, target) if c.upper() not in skip]
    low = low_cardinality(df, cols, max_levels)
    return [c for c in cols if c in low]


def ignored(columns: Sequence[str]) -> list[str]:
    """Columns that the ranking leaves out by their names."""
    parts, folded = codes.IV_IGNORE_PARTS, codes.IV_IGNORE_ANY_CASE
    return [
        c
        for c in columns
        if c in codes.IV_IGNORE_NAMES
        or any(p in c for p in parts)
        or any(p in c.lower() for p in folded)
    ]


def iv_ranking(
    df: DataFrame, target: str, ignore: Sequence[str] = (), max_levels: int = MAX_LEVELS
) -> DataFrame:
    """IV and strength per eligible feature, strongest first; empty when none is eligible."""
    table = woe_table(df, eligible(df, target, ignore, max_levels), target)
    return (
        table.groupBy("feature")
        .agg(F.sum("iv").alias("iv"))
        .withColumn("strength", strength(F.col("iv")))
        .orderBy(F.desc("iv"), "feature")
    )


def iv_top_k(ranking: DataFrame, k: int = 20) -> DataFrame:
    return ranking.orderBy(F.desc("iv"), "feature").limit(k)


def woe_transform(
    df: DataFrame,
    target: str,
    ignore: Sequence[str] = (),
    max_levels: int = MAX_LEVELS,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` plus ``<feature>_woe``; levels without a WoE get 0.

    The finished map has at most ``max_levels + 1`` entries per feature and becomes a
    literal, so the rows are neither shuffled nor joined.
    """
    if features is None:
        features = eligible(df, target, ignore, max_levels)
    elif wide := sorted(set(features) - set(low_cardinality(df, list(features), max_levels))):
        raise ValueError(f"more than {max_levels} levels: {', '.join(wide)}")
    found: dict[str, list[tuple[str, float]]] = {c: [] for c in features}
    known = woe_table(df, features, target).filter(F.col("woe").isNotNull())
    for r in known.select("feature", "level", "woe").collect():
        found[r["feature"]].append((r["level"], r["woe"]))

    def lookup(c: str) -> Column:
        if not found[c]:
            return F.lit(0.0)
        pairs = reduce(
            lambda acc, kv: [*acc, F.lit(kv[0]), F.lit(kv[1])], sorted(found[c]), []
        )
        level = F.coalesce(_q(c).cast("string"), F.lit(MISSING))
        return F.coalesce(F.try_element_at(F.create_map(*pairs), level), F.lit(0.0))

    return df.select("*", *[lookup(c).alias(f"{c}_woe") for c in features])


def woe_summary(
    df: DataFrame, target: str, ignore: Sequence[str] = (), max_levels: int = MAX_LEVELS
) -> DataFrame:
    """How many categorical inputs there are, were computed and were skipped."""
    total = len(candidates(df, target))
    done = len(eligible(df, target, ignore, max_levels))
    return df.sparkSession.createDataFrame(
        [(total, done, total - done)], "inputs bigint, computed bigint, skipped bigint"
    )


def dice_view(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Volume and target mean per level of one feature, highest mean first."""
    return (
        df.groupBy(F.coalesce(_q(feature).cast("string"), F.lit(MISSING)).alias("level"))
        .agg(F.count(_q(target)).alias("vol"), F.avg(_q(target)).alias("rate"))
        .orderBy(F.desc("rate"), "level")
    )
