"""Exclusion rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from ..functions.scalars import any_of, as_int

PREFIX = "excl_"
RULES = (
    "underage",
    "low_income",
    "recent_decline",
    "app_completed",
    "app_inprogress",
    "bureau_nohit",
    "credit_freeze",
    "ssn_mismatch",
    "dob_mismatch",
    "fraud_alert",
    "invalid_fico",
    "invalid_vantage",
    "low_fico",
    "no_open_trade",
    "low_trade_count",
    "low_vantage",
    "thin_oldest_trade",
    "thin_bureau",
    "recent_bankruptcy",
    "recent_chargeoff",
    "test_application",
    "ever_fraud_co",
    "fraud_suspect",
    "synthetic_3rd",
    "fraud_app",
)


@dataclass(frozen=True)
class RuleColumns:
    """Columns the exclusion rules read."""

    decline_code: str = "decline_code"
    income: str = "income"
    fico: str = "fico"
    vantage: str = "vantage"
    vantage_numeric: bool = True
    open_trades: str = "open_trades"
    total_trades: str = "total_trades"
    oldest_trade_months: str = "oldest_trade_months"
    bureau_months: str = "bureau_months"
    bankruptcy_months: str = "bankruptcy_months"
    chargeoff_months: str = "chargeoff_months"
    is_test: str = "is_test"
    fraud_suspect: str = "fraud_suspect"
    ever_fraud: str = "ever_fraud"
    synthetic_third_date: str = "synthetic_third_date"
    fraud_app: str = "fraud_app_ind"


def exclusion_rules(cols: RuleColumns = RuleColumns()) -> dict[str, Column]:
    """The 25 named conditions.  A NULL comparison does not exclude; only tests of
    missingness do."""

    def declined(rule: str) -> Column:
        return F.col(cols.decline_code) == codes.DECLINE_CODES[rule]

    def months(name: str) -> Column:
        return as_int(F.col(name), numeric=False)

    fico = F.col(cols.fico)
    vantage = as_int(F.col(cols.vantage), cols.vantage_numeric)
    bankruptcy = months(cols.bankruptcy_months).between(0, 7)

    def missing_or(name: str, cond: Column) -> Column:
        return F.col(name).isNull() | cond

    return {
        "underage": declined("underage"),
        "low_income": F.col(cols.income) < 6000,
        "recent_decline": declined("recent_decline"),
        "app_completed": declined("app_completed"),
        "app_inprogress": declined("app_inprogress"),
        "bureau_nohit": declined("bureau_nohit"),
        "credit_freeze": declined("credit_freeze"),
        "ssn_mismatch": declined("ssn_mismatch"),
        "dob_mismatch": declined("dob_mismatch"),
        "fraud_alert": bankruptcy,
        "invalid_fico": missing_or(cols.fico, ~fico.between(300, 850)),
        "invalid_vantage": missing_or(cols.vantage, ~vantage.between(300, 850)),
        "low_fico": fico < 540,
        "no_open_trade": missing_or(cols.open_trades, months(cols.open_trades) == 0),
        "low_trade_count": months(cols.total_trades) < 2,
        "low_vantage": vantage < 540,
        "thin_oldest_trade": missing_or(
            cols.oldest_trade_months, months(cols.oldest_trade_months) <= 12
        ),
        "thin_bureau": missing_or(cols.bureau_months, months(cols.bureau_months) <= 12),
        "recent_bankruptcy": bankruptcy,
        "recent_chargeoff": months(cols.chargeoff_months).between(0, 4),
        "test_application": F.col(cols.is_test),
        "ever_fraud_co": F.col(cols.ever_fraud) == 1,
        "fraud_suspect": F.col(cols.fraud_suspect) != codes.NO_FRAUD_SUSPECT,
        "synthetic_3rd": F.col(cols.synthetic_third_date).isNotNull(),
        "fraud_app": F.col(cols.fraud_app) == 1,
    }


def flag_names(
    rules: Mapping[str, Column] | Sequence[str] = RULES, prefix: str = PREFIX
) -> list[str]:
    return [prefix + name for name in rules]


def apply_rules(
    df: DataFrame,
    rules: Mapping[str, Column],
    prefix: str = PREFIX,
    total: str | None = "global_exclusion",
) -> DataFrame:
    """``df`` plus one 0/1 column per rule and ``total``: 1 if any rule holds.

    The rules are evaluated once into a bit mask.  Flags and total read the mask, not each
    other: a filter on a total made of 25 aliased conditions would let Spark's constraint
    propagation derive every combination of them.
    """
    if len(rules) > 62:
        raise ValueError("at most 62 rules fit in one mask")
    bits = [
        F.when(cond, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        for i, cond in enumerate(rules.values())
    ]
    masked = df.select("*", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("__mask"))
    return masked.select(
        *df.columns,
        *[
            F.expr(f"cast(getbit(__mask, {i}) as int) as `{prefix}{name}`")
            for i, name in enumerate(rules)
        ],
        *([F.when(F.col("__mask") != 0, 1).otherwise(0).alias(total)] if total else []),
    )


def any_flag(df: DataFrame, flags: Sequence[str], name: str) -> DataFrame:
    """``df`` plus 1 where any of the (never NULL) 0/1 ``flags`` is 1.

    For a handful of flags; :func:`apply_rules` gives the total of many rules itself.
    """
    return df.withColumn(name, any_of([F.col(f) for f in flags]))


def exclude(df: DataFrame, flag: str = "global_exclusion") -> DataFrame:
    """Rows the flag does not exclude; a NULL flag excludes."""
    return df.filter(F.col(flag) == 0)
