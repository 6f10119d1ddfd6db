"""Quality reports on the target, the exclusions and the balances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .population import first_per_key
from .target import COMPONENTS


def _total(c: str | Column) -> Column:
    return F.sum(c).cast("bigint")


def vintage_report(
    df: DataFrame,
    by: str = "vintage_month",
    target: str = "model_target",
    components: Sequence[str] = COMPONENTS,
) -> DataFrame:
    """Per vintage: accounts, bads, bad rate and the count of each component."""
    return (
        df.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            _total(target).alias("bad_count"),
            F.try_divide(F.sum(target), F.count(F.lit(1))).alias("bad_rate"),
            *[_total(c).alias(c) for c in components],
        )
        .orderBy(by)
    )


def waterfall(
    df: DataFrame,
    components: Sequence[str] = COMPONENTS,
    *,
    by: str | None = None,
    target: str = "model_target",
    excluded: str | None = "global_exclusion",
) -> DataFrame:
    """Component counts where a row counts for the first component it has.

    Fraud components have no lower MOB bound while the target has, so the components can
    add up to more than the target; ``component_gap`` reports by how much.
    """
    measures = [F.count(F.lit(1)).alias("accounts")]
    if excluded and by is None:
        measures += [
            _total(excluded).alias("total_excluded"),
            (F.count(F.lit(1)) - _total(excluded)).alias("accounts_kept"),
        ]
    earlier = F.lit(False)
    parts = []
    for c in components:
        part = F.when(earlier, 0).otherwise(F.col(c))
        parts.append(part)
        measures.append(_total(part).alias(f"{c}_wf"))
        earlier = earlier | (F.col(c) == 1)
    measures.append(_total(target).alias("model_target"))
    if by is None:
        all_parts = parts[0]
        for p in parts[1:]:
            all_parts = all_parts + p
        return df.agg(*measures, (_total(all_parts) - _total(target)).alias("component_gap"))
    return df.groupBy(by).agg(*measures).orderBy(by)


def flag_counts(
    df: DataFrame, flags: Sequence[str], by: str = "vintage_month", total: str = "global_exclusion"
) -> DataFrame:
    return (
        df.groupBy(by)
        .agg(*[_total(f).alias(f) for f in flags], _total(total).alias("total_excluded"))
        .orderBy(by)
    )


def reconcile(
    ours: DataFrame,
    other: DataFrame,
    *,
    key: str,
    value: str,
    other_value: str,
    other_order: str,
    tie: Sequence[str] = (),
    other_tie: Sequence[str] = (),
) -> DataFrame:
    """Accounts per label: ``NO match`` only where both values exist and differ.

    Each side is cut to one row per account before they meet, the other side to its
    earliest by ``other_order``.
    """
    mine = first_per_key(ours, [key], tie[0] if tie else value, tie[1:])
    theirs = first_per_key(other, [key], other_order, other_tie).select(
        key, F.col(other_value).alias("__other")
    )
    label = F.when(F.col(value) != F.col("__other"), "NO match").otherwise("Match")
    return (
        mine.select(key, value)
        .join(theirs, key, "left")
        .groupBy(label.alias("ind"))
        .agg(F.count(F.col(key)).alias("accounts"))
    )


def _balance_counts(balance: str) -> list[Column]:
    return [
        _total(F.when(F.col(balance) == 0, 1).otherwise(0)).alias("zero_bal_cnt"),
        _total(F.when(F.col(balance) < 0, 1).otherwise(0)).alias("neg_bal_cnt"),
    ]


def nonpositive_report(
    df: DataFrame, by: Sequence[str], balance: str, target: str = "model_target"
) -> DataFrame:
    """Bads with a balance of 0 or less, by flags (descending)."""
    return (
        df.filter((F.col(balance) <= 0) & (F.col(target) == 1))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("accounts"), *_balance_counts(balance))
        .orderBy(*[F.desc(c) for c in by])
    )


def balance_summary(
    df: DataFrame, averages: Mapping[str, str], balance: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rows, averages (name -> column) and counts of zero and negative balances."""
    measures = [
        F.count(F.lit(1)).alias("accounts"),
        *[F.avg(c).alias(n) for n, c in averages.items()],
        *_balance_counts(balance),
    ]
    return df.groupBy(*by).agg(*measures) if by else df.agg(*measures)
