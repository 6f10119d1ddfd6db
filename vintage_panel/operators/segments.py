"""Revolving rates by behaviour segment and month on book."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from .screening import _q

SUMS = ("rvl_unit", "tot_nz_unit", "tot_rvl_dollar", "tot_nz_dollar")
METRICS = ("acct_mix", "unit_rate", "dollar_rate")


def segment_base(
    agg: DataFrame,
    variables: Sequence[str],
    *,
    status: str = "status",
    mob: str = "mob",
    book_month: str = "book_month",
    sums: Sequence[str] = SUMS,
    lo: int = 0,
    hi: int = 23,
) -> DataFrame:
    """Rows not charged off (an unknown status stays), MOB ``lo``..``hi``, sums as numbers."""
    return agg.filter(~F.col(status).eqNullSafe("Z") & F.col(mob).between(lo, hi)).select(
        mob, book_month, *[F.col(s).try_cast("double").alias(s) for s in sums], *variables
    )


def vintage_slice(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """Rows whose month lies between two ``YYYY-MM`` months, both included."""
    month = F.trunc(F.col(col), "month")
    return df.filter(month.between(F.lit(f"{start}-01").cast("date"), F.lit(f"{end}-01").cast("date")))


def _totals(df: DataFrame, variables: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The four sums per variable and level (and ``by``); rows without a level are left out."""
    long = df.select(
        *by, *SUMS, *[_q(v).cast("string").alias(v) for v in variables]
    ).unpivot([*by, *SUMS], [_q(v) for v in variables], "variable", "level")
    return (
        long.filter(F.col("level").isNotNull())
        .groupBy("variable", *by, "level")
        .agg(*[F.coalesce(F.sum(s), F.lit(0.0)).alias(s) for s in SUMS])
    )


def _rates() -> dict[str, Column]:
    return {
        "unit_rate": F.try_divide(F.col("rvl_unit"), F.col("tot_nz_unit")),
        "dollar_rate": F.try_divide(F.col("tot_rvl_dollar"), F.col("tot_nz_dollar")),
    }


def segment_rates(df: DataFrame, variables: Sequence[str], mob: str = "mob") -> DataFrame:
    """Sums and rates per (variable, MOB, level), all variables in one pass.

    A zero denominator gives NULL.
    """
    return _totals(df, variables, [mob]).select(
        "*", *[c.alias(n) for n, c in _rates().items()]
    )


def volume_pivot(
    rates: DataFrame,
    levels: Sequence[str] = codes.STACK_ORDER,
    *,
    lo: int = 0,
    hi: int = 23,
    mob: str = "mob",
    volume: str = "tot_nz_unit",
) -> DataFrame:
    """MOB x level volumes of one variable; absent MOBs and cells are 0."""
    table = rates.groupBy(mob).pivot("level", list(levels)).agg(F.sum(volume))
    months = rates.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias(mob))
    return months.join(table, mob, "left").select(
        mob, *[F.coalesce(_q(v), F.lit(0.0)).alias(v) for v in levels]
    )


def weighted_average(
    rates: DataFrame, weights: dict[str, str], by: Sequence[str] = ("variable",)
) -> DataFrame:
    """Weighted mean of each rate (rate -> weight); a NULL rate adds nothing but keeps its weight."""
    return rates.groupBy(*by).agg(
        *[
            F.try_divide(
                F.coalesce(F.sum(F.col(rate) * F.col(weight)), F.lit(0.0)), F.sum(weight)
            ).alias(f"avg_{rate}")
            for rate, weight in weights.items()
        ]
    )


def last_observation(
    rates: DataFrame, rates_of: Sequence[str] = ("unit_rate", "dollar_rate"), mob: str = "mob"
) -> DataFrame:
    """Rates at the highest MOB of each (variable, level)."""
    last = F.max_by(F.struct(*rates_of), F.col(mob)).alias("__last")
    return (
        rates.groupBy("variable", "level")
        .agg(F.max(mob).alias(f"last_{mob}"), last)
        .select("variable", "level", f"last_{mob}", *[F.col(f"__last.{r}").alias(r) for r in rates_of])
    )


def segment_snapshots(
    df: DataFrame, variables: Sequence[str], at: Sequence[int], mob: str = "mob"
) -> DataFrame:
    """At each MOB of ``at``: sums, share of units and rates per (variable, level).

    One pass over the panel for all of them.  The unit totals have one row per variable and
    MOB and are broadcast.
    """
    sums = _totals(df.filter(F.col(mob).isin(*at)), variables, [mob])
    whole = sums.groupBy("variable", mob).agg(F.sum("tot_nz_unit").alias("__units"))
    return sums.join(F.broadcast(whole), ["variable", mob]).select(
        mob,
        "variable",
        "level",
        *SUMS,
        F.when(F.col("__units") > 0, F.try_divide(F.col("tot_nz_unit"), F.col("__units"))).alias(
            "acct_mix"
        ),
        *[c.alias(n) for n, c in _rates().items()],
    )


def segment_matrix(
    snapshot: DataFrame,
    variables: Sequence[str],
    levels: Sequence[str] = codes.LEVEL_ORDER,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Level x variable tables of each metric in a fixed order; absent cells are NULL."""
    spark = snapshot.sparkSession
    frame = spark.createDataFrame(
        [(m, i, v, j) for i, m in enumerate(metrics) for j, v in enumerate(levels)],
        "metric string, metric_rank int, level string, level_rank int",
    )
    cells = (
        snapshot.unpivot(["variable", "level"], list(metrics), "metric", "value")
        .groupBy("metric", "level")
        .pivot("variable", list(variables))
        .agg(F.max("value"))
    )
    return (
        frame.join(cells, ["metric", "level"], "left")
        .orderBy("metric_rank", "level_rank")
        .select("metric", "level", "level_rank", *[_q(v) for v in variables])
    )


def level_rank(c: Column, order: Sequence[str] = codes.STACK_ORDER) -> Column:
    """Sort key that puts the canonical levels first; sort by it, then by name."""
    out = None
    for i, name in enumerate(order):
        out = F.when(c == name, i) if out is None else out.when(c == name, i)
    return F.lit(len(order)) if out is None else out.otherwise(F.lit(len(order)))


def ordered_levels(
    rates: DataFrame, order: Sequence[str] = codes.STACK_ORDER, level: str = "level"
) -> DataFrame:
    """Levels present, canonical ones first, others by name."""
    return (
        rates.select(level)
        .distinct()
        .withColumn("level_rank", level_rank(F.col(level), order))
        .orderBy("level_rank", level)
    )
