"""Performance flags per month on book and the model target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from ..functions.dates import book_vintage, month_diff
from .lookups import first_event_dates, shift_events
from .panel import FAMILIES, event_families, event_masks, flag_at, mask_name
from .skew import lookup_join

HORIZON = 24
DPD_CUT = 90
EVER = {
    "chargeoff": "ever_chargeoff",
    "settlement": "ever_settlement",
    "workout": "ever_workout",
}
COMPONENTS = (
    "ever_chargeoff",
    "ever_settlement",
    "ever_workout",
    "dpd90_at_end",
    "ever_synthetic_first",
    "ever_first_party",
)


def _bit(mob: Column, hi: int) -> Column:
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), mob.cast("int"))
    return F.when(mob.between(1, hi), one).otherwise(F.lit(0).cast("bigint"))


def snapshot_lookup(
    panel: DataFrame,
    key: str,
    *,
    hi: int = HORIZON,
    open_date_from: str = "end",
    check_unique: bool = True,
) -> DataFrame:
    """Open date and DPD of the MOB-``hi`` snapshot and the first MOB at 90+ DPD, in one pass.

    ``open_date_from="end"`` takes the open date from the MOB-``hi`` snapshot only;
    ``"any"`` takes the earliest one of all snapshots.
    """
    if open_date_from not in ("end", "any"):
        raise ValueError("open_date_from must be 'end' or 'any'")
    at_end, late = F.col("mob") == hi, F.col("dpd") >= DPD_CUT
    rows = panel.filter(F.col(key).isNotNull())
    if open_date_from == "end":
        rows, opened = rows.filter(at_end | late), F.max(F.when(at_end, F.col("open_date")))
    else:
        opened = F.min("open_date")
    out = rows.groupBy(key).agg(
        opened.alias("open_date"),
        F.max(F.when(at_end, F.col("dpd"))).alias("__dpd"),
        F.sum(F.when(at_end, 1)).alias("__rows"),
        F.min(F.when(late, F.col("mob"))).alias("first_dpd90_mob"),
    )
    dpd_at_end = F.col("__dpd")
    if check_unique:
        dpd_at_end = F.when(F.coalesce(F.col("__rows"), F.lit(0)) <= 1, dpd_at_end).otherwise(
            F.raise_error(F.lit(f"more than one MOB-{hi} snapshot per {key}"))
        )
    return out.select(key, "open_date", dpd_at_end.alias("dpd_at_end"), "first_dpd90_mob")


def history_lookup(hist: DataFrame, key: str, *, lo: int = 1, hi: int = HORIZON) -> DataFrame:
    """Event masks, first event MOBs and the ever-fraud flag of each account, in one pass."""
    inside = F.col("mob").between(lo, hi)
    status, reason = codes.FRAUD_CHARGEOFF
    fraud = (F.col("status") == status) & (F.col("reason") == reason)
    flags = {n: F.when(inside & c, 1).otherwise(0) for n, c in event_families().items()}
    rows = hist.filter(F.col(key).isNotNull()).select(
        key,
        "mob",
        *[c.alias(n) for n, c in flags.items()],
        F.when(fraud, 1).otherwise(0).alias("ever_fraud"),
    )
    wanted = F.col("ever_fraud") == 1
    for n in FAMILIES:
        wanted = wanted | (F.col(n) == 1)
    return event_masks(
        rows.filter(wanted), key, "mob", eventless=True, extra=[F.max("ever_fraud").alias("ever_fraud")]
    )


def account_lookups(
    accounts: DataFrame,
    *,
    key: str,
    hist: DataFrame,
    panel: DataFrame,
    shifts: DataFrame,
    disputed: DataFrame | None = None,
    hi: int = HORIZON,
    open_date_from: str = "end",
    check_unique: bool = True,
) -> DataFrame:
    """Everything exclusions and target need, one row per account of ``accounts``.

    Every part is an aggregate by account, so the parts are already partitioned alike and
    joining them moves no rows again.
    """
    dates = first_event_dates(shifts.filter(F.col(key).isNotNull()), key, "as_of", shift_events())
    out = (
        accounts.select(key)
        .filter(F.col(key).isNotNull())
        .distinct()
        .join(history_lookup(hist, key, hi=hi), key, "left")
        .join(
            snapshot_lookup(
                panel, key, hi=hi, open_date_from=open_date_from, check_unique=check_unique
            ),
            key,
            "left",
        )
        .join(dates, key, "left")
    )
    if disputed is not None:
        hit = disputed.select(key, F.lit(1).alias("fraud_app_ind"))
        out = out.join(hit, key, "left")
    return out


def with_target_flags(
    joined: DataFrame, keep: Sequence[str], hi: int = HORIZON
) -> DataFrame:
    """``keep`` columns plus bad flags per MOB, the target (bad at any MOB), "ever" flags,
    first MOBs and fraud MOBs.

    ``joined`` holds the columns of :func:`account_lookups`.  The bad MOBs of an account
    form one bit mask: events, the two fraud MOBs within 1..``hi`` and 90+ DPD at ``hi``.
    """
    zero = F.lit(0).cast("bigint")
    masks = {n: F.coalesce(F.col(mask_name(n)), zero) for n in FAMILIES}
    syn = month_diff(F.col("synthetic_first_date"), F.col("open_date"))
    fpf = month_diff(F.col("first_party_date"), F.col("open_date"))
    late = F.col("dpd_at_end") >= DPD_CUT
    bad = _bit(syn, hi).bitwiseOR(_bit(fpf, hi)).bitwiseOR(
        F.when(late, F.lit(1 << hi).cast("bigint")).otherwise(zero)
    )
    for n in FAMILIES:
        bad = bad.bitwiseOR(masks[n])
    firsts = [*[f"first_{n}_mob" for n in FAMILIES], "first_dpd90_mob", "first_event_mob"]
    staged = joined.select(
        *keep,
        "open_date",
        bad.alias("__bad"),
        *[F.when(masks[n] != 0, 1).otherwise(0).alias(e) for n, e in EVER.items()],
        F.when(late, 1).otherwise(0).alias("dpd90_at_end"),
        syn.alias("synthetic_first_mob"),
        fpf.alias("first_party_mob"),
        *firsts,
    )
    return staged.select(
        *keep,
        "open_date",
        book_vintage(F.col("open_date")).alias("book_vintage"),
        *[flag_at("__bad", k).alias(f"bad_mob{k}") for k in range(1, hi + 1)],
        F.when(F.col("__bad") != 0, 1).otherwise(0).alias("model_target"),
        *EVER.values(),
        "dpd90_at_end",
        # no lower bound: a fraud date before the open date counts as "ever"
        F.when(F.col("synthetic_first_mob") <= hi, 1).otherwise(0).alias("ever_synthetic_first"),
        F.when(F.col("first_party_mob") <= hi, 1).otherwise(0).alias("ever_first_party"),
        *firsts,
        "synthetic_first_mob",
        "first_party_mob",
    )


def base_with_flags(
    base: DataFrame,
    lookups: DataFrame,
    *,
    key: str,
    hot: DataFrame | tuple | None = None,
    hi: int = HORIZON,
) -> DataFrame:
    """``base`` with target flags; all lookups arrive in one table, so it is joined once."""
    return with_target_flags(lookup_join(base, lookups, key, hot=hot), base.columns, hi)


def first_bad_mob(hi: int = HORIZON) -> Column:
    """MOB of the first component in priority order; not the earliest of them."""
    return (
        F.when(F.col("first_event_mob").isNotNull(), F.col("first_event_mob"))
        .when(F.col("dpd90_at_end") == 1, F.lit(hi))
        .when(F.col("ever_synthetic_first") == 1, F.col("synthetic_first_mob"))
        .when(F.col("ever_first_party") == 1, F.col("first_party_mob"))
    )


def model_target(df: DataFrame, key: str, hi: int = HORIZON) -> DataFrame:
    """Adds the first bad MOB and the account id under a second name."""
    return df.select("*", F.col(key).alias("acct_id"), first_bad_mob(hi).alias("first_bad_mob"))
