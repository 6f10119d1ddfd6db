"""Scalar rules: bands, labels, pattern tags, flags, rate lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Band:
    """One label with the bounds that select it (all given bounds must hold)."""

    label: str
    ge: float | None = None
    le: float | None = None
    lt: float | None = None

    def test(self, c: Column) -> Column:
        parts = [
            p
            for p in (
                c >= self.ge if self.ge is not None else None,
                c <= self.le if self.le is not None else None,
                c < self.lt if self.lt is not None else None,
            )
            if p is not None
        ]
        cond = parts[0]
        for p in parts[1:]:
            cond = cond & p
        return cond


def first_match(pairs: Sequence[tuple[Column, object]], default: object) -> Column:
    """Value of the first condition that holds, else ``default``."""
    if not pairs:
        return F.lit(default)
    out = None
    for cond, value in pairs:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def band(c: Column, bands: Sequence[Band], default: str) -> Column:
    """NULL and values between closed integer bands get ``default``."""
    return first_match([(b.test(c), b.label) for b in bands], default)


def map_labels(c: Column, labels: Mapping[str, str], default: str | None) -> Column:
    return first_match([(c == code, label) for code, label in labels.items()], default)


def as_int(c: Column, numeric: bool) -> Column:
    """Integer cast that rounds fractions half away from zero instead of truncating."""
    return F.round(c).cast("bigint") if numeric else c.cast("bigint")


def padded_int(c: Column, strict: bool = True) -> Column:
    """``'007'`` -> 7.  Malformed text raises unless ``strict`` is off."""
    return c.cast("bigint") if strict else c.try_cast("bigint")


def pattern_tag(
    c: Column,
    revolve: str = "R",
    transact: str = "T",
    missing: str = "-2",
    share: float = 0.5,
) -> Column:
    """Behaviour of a one-character-per-month string by the share of each character.

    Revolving is tested first, so an even split counts as revolving.
    """
    size = F.length(c)

    def part(ch: str) -> Column:
        kept = F.length(F.translate(c, ch, ""))
        return F.try_divide(size - kept, size) >= share

    return first_match(
        [
            (c.isNull() | (c == missing), "Mixed Behavior"),
            (part(revolve), "Revolver"),
            (part(transact), "Transactor"),
        ],
        "Mixed Behavior",
    )


def threshold_flag(c: Column, cut: float = 1000) -> Column:
    """1 above ``cut``, 0 from 0 to ``cut``, NULL for negative (special) or NULL values."""
    return F.when(c > cut, 1).when(c >= 0, 0)


@dataclass(frozen=True)
class ArmRegime:
    """Bucket limits of a test design: (low, mid] is arm 1, (mid, high] is arm 2."""

    low: float
    mid: float
    high: float

    def arms(self, bucket: Column, suffix: str) -> Column:
        return first_match(
            [
                ((bucket > self.low) & (bucket <= self.mid), f"1.L {suffix}"),
                ((bucket > self.mid) & (bucket <= self.high), f"2.H {suffix}"),
            ],
            f"3.BAU {suffix}",
        )


def test_segment(
    bucket: Column,
    entry: Column,
    change: date,
    before: ArmRegime,
    after: ArmRegime,
    suffix: str,
) -> Column:
    """Test arm of a random bucket; limits change after ``change``, NULL date is BAU."""
    return (
        F.when(entry <= F.lit(change), before.arms(bucket, suffix))
        .when(entry > F.lit(change), after.arms(bucket, suffix))
        .otherwise(F.lit(f"3.BAU {suffix}"))
    )


test_segment.__test__ = False  # not a pytest case


def score_fallback(*scores: Column) -> Column:
    """First positive score, else NULL."""
    return F.coalesce(*[F.when(s > 0, s) for s in scores])


def date_band_rate(
    c: Column, bands: Sequence[tuple[date, date, float]], default: float
) -> Column:
    """Rate by closed date interval.  Rates are Python floats, hence double literals."""
    return first_match(
        [(c.between(F.lit(lo), F.lit(hi)), F.lit(float(rate))) for lo, hi, rate in bands],
        F.lit(float(default)),
    )


def dpd(days: Column, offset: int = 29) -> Column:
    """Days past due, floored at 0.  NULL stays NULL (``greatest`` would skip it)."""
    past = days - offset
    return F.when(past < 0, 0).otherwise(past)


def dpd_columns(
    days: Column, offset: int = 29, cuts: Sequence[int] = (15, 30, 45, 60, 90)
) -> dict[str, Column]:
    """``dpd`` and one ``dpdNplus`` flag per cut; NULL days give flag 0."""
    return {"dpd": dpd(days, offset)} | {
        f"dpd{n}plus": F.when(days - offset >= n, 1).otherwise(0) for n in cuts
    }


def any_of(flags: Sequence[Column]) -> Column:
    """1 if any 0/1 flag is 1; flags must not be NULL."""
    return F.greatest(*flags) if len(flags) > 1 else flags[0]


def event_mob(first_choice: Column, *others: Column, missing: int = 99) -> Column:
    """MOB of the leading event if there is one, else the smallest of the others."""
    rest = [F.coalesce(o, F.lit(missing)) for o in others]
    return F.coalesce(first_choice, F.least(*rest) if len(rest) > 1 else rest[0])
