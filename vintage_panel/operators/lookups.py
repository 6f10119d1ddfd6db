"""Flags, dates and measures fetched from other tables by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from .skew import expanding_join, lookup_join


def accounts_where(hist: DataFrame, key: str, cond: Column) -> DataFrame:
    """Distinct keys with at least one row that meets ``cond``."""
    return hist.filter(cond & F.col(key).isNotNull()).select(key).distinct()


def ever_flag(
    base: DataFrame,
    hist: DataFrame,
    on: str,
    cond: Column,
    name: str,
    hist_key: str | None = None,
    *,
    hot: DataFrame | tuple | None = None,
) -> DataFrame:
    """``base`` plus a 0/1 column: did the key ever meet ``cond`` in ``hist``."""
    hit = accounts_where(hist, hist_key or on, cond)
    hit = hit.select(F.col(hist_key or on).alias(on), F.lit(1).alias(name))
    joined = lookup_join(base, hit, on, hot=hot)
    return joined.select(*base.columns, F.coalesce(F.col(name), F.lit(0)).alias(name))


def first_event_dates(
    hist: DataFrame, key: str, date: str, events: Mapping[str, Column]
) -> DataFrame:
    """Earliest date of each event per key, all events in one pass."""
    any_event = F.lit(False)
    for cond in events.values():
        any_event = any_event | cond
    return (
        hist.filter(any_event)
        .groupBy(key)
        .agg(*[F.min(F.when(cond, F.col(date))).alias(name) for name, cond in events.items()])
    )


def shift_events(status: str = "status", reason: str = "reason") -> dict[str, Column]:
    """The three fraud dates read from the status-shift history."""
    shifted = F.col(status) == codes.SHIFT_STATUS
    return {
        "first_party_date": shifted & (F.col(reason) == codes.FIRST_PARTY_REASON),
        "synthetic_first_date": shifted & (F.col(reason) == codes.SYNTHETIC_FIRST_REASON),
        "synthetic_third_date": shifted & (F.col(reason) == codes.SYNTHETIC_THIRD_REASON),
    }


def disputed_accounts(
    cases: DataFrame,
    mislabeled: DataFrame,
    *,
    listed: Column | None = None,
    key: str = "account_id",
    reported: str = "reported",
    sums: Sequence[str] = ("disputed", "chargeoff"),
    mislabeled_key: str = "account_no",
    misfiled: str = "filed_incorrectly",
) -> DataFrame:
    """Latest report date and totals of accounts that have a listed, rightly filed case.

    ``listed`` selects the cases that put an account on the list; the totals then cover
    all cases of the account.  Accounts filed wrongly are mapped to NULL in the list and
    so never match; a NULL mark counts as rightly filed.
    """
    if listed is None:
        listed = (F.col("type_cd") == codes.DISPUTE_TYPE) & (
            F.col("in_db") == codes.DISPUTE_NOT_IN_DB
        )
    marks = (
        mislabeled.select(
            F.col(mislabeled_key).cast("string").alias(key), F.col(misfiled).alias("__misfiled")
        )
        .groupBy(key)
        # one rightly filed mark (false or NULL) is enough to keep the account listed
        .agg(F.min(F.coalesce(F.col("__misfiled"), F.lit(False))).alias("__misfiled"))
    )
    on_list = (
        accounts_where(cases, key, listed)
        .join(marks, key, "left")
        .filter(~F.coalesce(F.col("__misfiled"), F.lit(False)))
        .select(key)
    )
    totals = cases.groupBy(key).agg(
        F.max(reported).alias(reported), *[F.sum(c).alias(c) for c in sums]
    )
    return totals.join(on_list, key, "left_semi")


def latest_nonnull_date(
    df: DataFrame, key: str, date: str, measures: Sequence[str], name: str = "nonnull_date"
) -> DataFrame:
    """Newest date per key on which any of ``measures`` is not NULL."""
    known = F.coalesce(*[F.col(m).cast("string") for m in measures]).isNotNull()
    return df.filter(known).groupBy(key).agg(F.max(date).alias(name))


def latest_nonnull_rows(
    df: DataFrame, key: str, date: str, measures: Sequence[str], total: str
) -> DataFrame:
    """All distinct measure sums of each key's newest non-null date.

    The sum is NULL when one measure is NULL.  Several rows on that date are all kept.
    """
    added = F.col(measures[0])
    for m in measures[1:]:
        added = added + F.col(m)
    known = F.coalesce(*[F.col(m).cast("string") for m in measures]).isNotNull()
    by_date = (
        df.groupBy(key, date)
        .agg(F.max(known).alias("__known"), F.collect_set(F.struct(added.alias("sum"))).alias("__sums"))
        .filter(F.col("__known") & F.col(date).isNotNull())
    )
    newest = by_date.groupBy(key).agg(F.max(F.struct(date, "__sums")).alias("__newest"))
    return newest.select(
        key, F.col(f"__newest.{date}").alias(date), F.explode("__newest.__sums").alias("__s")
    ).select(key, date, F.col("__s.sum").alias(total))


def fraud_applications(
    apps: DataFrame,
    disputed: DataFrame,
    latest: DataFrame,
    *,
    key: str = "account_id",
    indicator: str = "fraud_app_ind",
) -> DataFrame:
    """Distinct account rows with dispute indicator, dispute totals and latest measures.

    ``disputed`` and ``latest`` are keyed by ``key``.  Accounts are reduced to distinct
    ones before the joins, which gives the same rows as a distinct after them; the NULL
    account stays one row.
    """
    accounts = apps.select(key).distinct()
    totals = [c for c in disputed.columns if c != key]
    measures = [c for c in latest.columns if c != key]
    return (
        accounts.join(latest, key, "left")
        .join(disputed.withColumn("__hit", F.lit(1)), key, "left")
        .select(
            key, F.coalesce(F.col("__hit"), F.lit(0)).alias(indicator), *totals, *measures
        )
        .distinct()
    )


def join_snapshots(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Two snapshot tables on account and date; the date spreads a busy account over tasks."""
    return left.join(right, list(on), "left")


def with_suffix_key(df: DataFrame, col: str, name: str, n: int = 16) -> DataFrame:
    """Adds the last ``n`` characters of a long key, once, so joins on it are equi-joins."""
    return df.withColumn(name, F.right(F.col(col), F.lit(n)))


def join_on_suffix(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    n: int = 16,
    *,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left`` left-joined to the rows whose key ends in its key, many per key."""
    keyed = with_suffix_key(right, right_key, left_key, n)
    return expanding_join(left, keyed, left_key, hot=hot)


def join_on_cast_key(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    hot: DataFrame | tuple | None = None,
) -> DataFrame:
    """``left`` (text key) left-joined to ``right`` (non-text key)."""
    keyed = right.withColumn(left_key, F.col(right_key).cast("string"))
    if right_key != left_key:
        keyed = keyed.drop(right_key)
    return lookup_join(left, keyed, left_key, hot=hot)


def acquisition_cost(
    channel: Column,
    year: Column,
    table: Mapping[str, Mapping[int | None, float]] = codes.ACQUISITION_COST,
    default: float = codes.ACQUISITION_COST_DEFAULT,
) -> Column:
    """Cost by channel and year; ``None`` holds a channel's cost for other years."""
    out = None
    for label, by_year in table.items():
        cost = F.lit(by_year[None])
        for y, value in by_year.items():
            if y is not None:
                cost = F.when(year == y, F.lit(value)).otherwise(cost)
        out = F.when(channel == label, cost) if out is None else out.when(channel == label, cost)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))
