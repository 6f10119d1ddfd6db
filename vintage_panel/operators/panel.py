"""Account-by-month-on-book events, snapshots and wide panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from ..functions.dates import is_month_end, month_diff, month_index
from ..functions.scalars import dpd_columns
from .skew import lookup_join

FAMILIES = ("chargeoff", "settlement", "workout")


def event_families(status: str = "status", reason: str = "reason") -> dict[str, Column]:
    """Conditions of the three event families on the account history."""
    return {
        "chargeoff": F.col(status).isin(*codes.CHARGEOFF_STATUS),
        "settlement": F.col(reason).isin(*codes.SETTLEMENT_REASONS),
        "workout": F.col(reason) == codes.WORKOUT_REASON,
    }


def mob_events(
    accounts: DataFrame,
    hist: DataFrame,
    key: str,
    mob: str,
    families: Mapping[str, Column],
    lo: int = 1,
    hi: int = 24,
) -> DataFrame:
    """0/1 per event family for each (account, MOB) of the listed accounts.

    The history is reduced to at most ``hi - lo + 1`` rows per account before it meets
    the account list.
    """
    events = (
        hist.filter(F.col(mob).between(lo, hi) & F.col(key).isNotNull())
        .groupBy(key, mob)
        .agg(
            *[F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in families.items()]
        )
    )
    return events.join(accounts.select(key).distinct(), key, "left_semi")


def _bits(flag: str, mob: str) -> Column:
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(mob).cast("int"))
    return F.bit_or(F.when(F.col(flag) == 1, bit).otherwise(F.lit(0).cast("bigint")))


def mask_name(family: str) -> str:
    return f"{family}_mobs"


def _any(names: Sequence[str]) -> Column:
    return reduce(or_, [F.col(n) == 1 for n in names])


def _first_mobs(mob: str, names: Sequence[str]) -> list[Column]:
    return [
        *[F.min(F.when(F.col(n) == 1, F.col(mob))).alias(f"first_{n}_mob") for n in names],
        F.min(F.when(_any(names), F.col(mob))).alias("first_event_mob"),
    ]


def event_masks(
    events: DataFrame,
    key: str,
    mob: str,
    names: Sequence[str] = FAMILIES,
    eventless: bool = False,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per account one bit mask of event MOBs and the first MOB per family, and of any.

    Three 64-bit masks carry what a pivot would spread over 3 x 24 columns, so little is
    shuffled and the aggregate stays small enough for code generation.  Accounts without
    any event are left out before the shuffle unless ``eventless`` asks for them.
    ``extra`` are further aggregates of the same pass.
    """
    rows = events if eventless else events.filter(_any(names))
    return rows.groupBy(key).agg(
        *[_bits(n, mob).alias(mask_name(n)) for n in names], *_first_mobs(mob, names), *extra
    )


def flag_at(mask: str, mob: int) -> Column:
    """0/1 flag of one MOB in a bit-mask column."""
    return F.expr(f"cast(getbit({mask}, {mob}) as int)")


def mob_pivot(
    events: DataFrame,
    key: str,
    mob: str,
    names: Sequence[str] = FAMILIES,
    lo: int = 1,
    hi: int = 24,
) -> DataFrame:
    """One row per account: ``<family>_mob<k>`` flags for every MOB and the first MOBs."""
    if not 0 <= lo <= hi <= 62:
        raise ValueError("MOB range must lie within 0..62")
    masks = event_masks(events, key, mob, names, eventless=True)
    return masks.select(
        key,
        *[
            flag_at(mask_name(n), k).alias(f"{n}_mob{k}")
            for n in names
            for k in range(lo, hi + 1)
        ],
        *[f"first_{n}_mob" for n in names],
        "first_event_mob",
    )


def first_event_mob(
    events: DataFrame, key: str, mob: str, names: Sequence[str] = FAMILIES
) -> DataFrame:
    """Earliest MOB per family and of any family, for accounts in ``events``."""
    return events.groupBy(key).agg(*_first_mobs(mob, names))


def month_end_only(df: DataFrame, col: str) -> DataFrame:
    return df.filter(is_month_end(F.col(col)))


def delinquency_panel(
    portfolio: DataFrame,
    *,
    full_key: str = "full_acct",
    as_of: str = "as_of",
    opened: str = "open_date",
    days: str = "del_days",
    key: str = "acct_id",
    suffix: int | None = 16,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Month-end snapshots with account id, MOB, DPD and DPD flags.

    ``suffix=None`` takes the account id as stored, in the column ``key``.
    """
    account = F.col(key) if suffix is None else F.right(F.col(full_key), F.lit(suffix)).alias(key)
    return month_end_only(portfolio, as_of).select(
        account,
        F.col(as_of),
        F.col(opened).alias("open_date"),
        *keep,
        month_diff(F.col(as_of), F.col(opened)).alias("mob"),
        *[c.alias(n) for n, c in dpd_columns(F.col(days)).items()],
    )


def dpd_panel(
    portfolio: DataFrame,
    master: DataFrame,
    *,
    full_key: str = "full_acct",
    as_of: str = "as_of",
    status: str = "status",
    balance: str = "balance",
    **columns,
) -> DataFrame:
    """:func:`delinquency_panel` with status and the balance of the second daily table
    (missing 0).  Both tables are cut to month ends before they are joined."""
    left = delinquency_panel(
        portfolio, full_key=full_key, as_of=as_of, keep=[full_key, status], **columns
    )
    right = month_end_only(master.select(full_key, as_of, balance), as_of)
    return (
        left.join(right, [full_key, as_of], "left")
        .drop(full_key)
        .withColumn(balance, F.coalesce(F.col(balance), F.lit(0.0)))
    )


def first_mob_where(
    panel: DataFrame, key: str, mob: str, cond: Column, name: str = "first_dpd90_mob"
) -> DataFrame:
    return panel.filter(cond).groupBy(key).agg(F.min(mob).alias(name))


def never_active(
    hist: DataFrame, key: str, mob: str, active: str, hi: int = 24, months: int | None = None
) -> DataFrame:
    """Accounts never active up to MOB ``hi`` with all ``months`` (default ``hi + 1``) present."""
    months = hi + 1 if months is None else months
    return (
        hist.filter(F.col(mob) <= hi)
        .groupBy(key)
        .agg(F.max(active).alias("__active"), F.count_distinct(mob).alias("__months"))
        .filter((F.col("__active") == 0) & (F.col("__months") == months))
        .select(key, F.lit(1).alias("never_active"))
    )


def month_series(
    snaps: DataFrame, key: str, as_of: str, value: str, check_unique: bool = True
) -> DataFrame:
    """One row per account with its month-end values as a map month index -> value.

    The snapshots are first reduced to one row per account and month end, on the map
    side already, so the map of an account holds one entry per calendar month at most.
    Two snapshots of one account on one date raise, or keep the larger value when
    ``check_unique`` is off.
    """
    per_month = (
        month_end_only(snaps.select(key, as_of, value), as_of)
        .filter(F.col(key).isNotNull())
        .groupBy(key, as_of)
        .agg(F.max(value).alias("__value"), F.count(F.lit(1)).alias("__rows"))
    )
    found = F.col("__value")
    if check_unique:
        found = F.when(F.col("__rows") == 1, found).otherwise(
            F.raise_error(F.lit(f"more than one snapshot per {key} and {as_of}"))
        )
    return (
        per_month.select(key, month_index(F.col(as_of)).alias("__month"), found.alias("__value"))
        .groupBy(key)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("__month", "__value"))).alias("__series")
        )
    )


def value_at_event(
    series: Column, start_month: Column, event: Column, default_k: int = 24
) -> Column:
    """Value at the event month if that is at most ``default_k``, else at ``default_k``.

    Missing values count as 0; an event month below 1 has no value.
    """
    zero = F.lit(0.0)
    at_event = F.coalesce(F.try_element_at(series, start_month + event.cast("int")), zero)
    at_end = F.coalesce(F.try_element_at(series, start_month + default_k), zero)
    return F.when(event <= default_k, F.when(event >= 1, at_event)).otherwise(at_end)


def wide_panel(
    base: DataFrame,
    snaps: DataFrame,
    *,
    key: str,
    start: str,
    as_of: str,
    value: str,
    prefix: str,
    lo: int = 0,
    hi: int = 24,
    missing: bool = False,
    event: Column | None = None,
    event_name: str | None = None,
    snap_key: str | None = None,
    check_unique: bool = True,
    hot: DataFrame | tuple | None = None,
) -> DataFrame:
    """``base`` plus ``<prefix>k``: the value at the month end k months after ``start``.

    Missing values become 0; ``missing`` adds ``<prefix>k_missing`` flags and ``event``
    the value at an event month.  One join whatever the number of months; rows of
    ``base`` are neither lost nor multiplied.
    """
    if snap_key and snap_key != key:
        snaps = snaps.withColumnRenamed(snap_key, key)
    series = month_series(snaps, key, as_of, value, check_unique)
    joined = lookup_join(base, series, key, hot=hot).withColumn(
        "__start", month_index(F.col(start))
    )
    at = {k: f"try_element_at(__series, __start + {k})" for k in range(lo, hi + 1)}
    cols = [F.expr(f"coalesce({v}, 0D) as `{prefix}{k}`") for k, v in at.items()]
    if missing:
        cols += [F.expr(f"int({v} is null) as `{prefix}{k}_missing`") for k, v in at.items()]
    if event is not None:
        found = value_at_event(F.col("__series"), F.col("__start"), event, hi)
        cols.append(found.alias(event_name or f"{prefix}_at_event"))
    return joined.select(*base.columns, *cols)
