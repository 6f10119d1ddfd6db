from datetime import date

import pytest

from vintage_panel.operators import behaviour as beh
from vintage_panel.operators.skew import NO_HOT_KEYS
from vintage_panel.plans import builds

HIST = (
    "acct_id string, load_date date, status string, reason string, month_end_ind int, "
    "launch_phase string, fraud_flag string, accum_chargeoff int, revolver_flag string, "
    "merchant double, cash double, monthly_fee double, late_fee double, late_fee_refund double, "
    "annual_fee double, monthly_interest double, merch_apr double, principal double, "
    "payment double, payment_reversal double"
)
D = date(2024, 1, 31)


def hist(spark, *rows):
    base = dict(
        acct_id="a", load_date=D, status=" ", reason="00", month_end_ind=1, launch_phase="04A",
        fraud_flag="N", accum_chargeoff=0, revolver_flag="Revolver", merchant=1.0, cash=2.0,
        monthly_fee=40.0, late_fee=3.0, late_fee_refund=1.0, annual_fee=None,
        monthly_interest=1.0, merch_apr=20.0, principal=7.0, payment=5.0, payment_reversal=None,
    )
    return spark.createDataFrame(
        [tuple({**base, "acct_id": str(i), **r}.values()) for i, r in enumerate(rows)], HIST
    )


def test_null_reason_splits_the_two_filters(spark):
    df = hist(
        spark,
        {},
        {"status": "Z", "reason": None},  # unknown whether fraud charge-off
        {"status": "Z", "reason": "88"},
        {"status": "Z", "reason": "11"},
        {"status": None, "reason": "11"},
        {"launch_phase": "06B"},
        {"launch_phase": None},
        {"fraud_flag": None},
    )
    assert {r.acct_id for r in beh.monthly_fees(df).collect()} == {"0", "3", "4"}
    assert {r.acct_id for r in beh.revolver_months(df).collect()} == {"0", "1", "3", "4"}


def test_fee_arithmetic(spark):
    df = hist(
        spark,
        {},
        {"monthly_fee": 38.0},
        {"monthly_fee": None},
        {"late_fee": None, "merchant": None, "annual_fee": 39.0},
    )
    got = {r.acct_id: r for r in beh.monthly_fees(df).collect()}
    assert [got[i].net_other_fee for i in "0123"] == [37.0, 38.0, None, 40.0]
    assert [got[i].net_late_fee for i in "03"] == [2.0, -1.0]
    assert (got["3"].gross_sales, got["3"].net_annual_fee) == (2.0, 39.0)


def test_two_history_rows_on_a_day_raise(spark):
    df = hist(spark, {"acct_id": "a"}, {"acct_id": "a"})
    with pytest.raises(Exception, match="more than one history row"):
        beh.monthly_history(df).collect()
    assert beh.monthly_history(df, check_unique=False).count() == 2


def test_monthly_history_equals_the_three_filtered_tables(spark):
    df = hist(
        spark,
        {},
        {"month_end_ind": 0},
        {"accum_chargeoff": 1},
        {"revolver_flag": "Transactor"},
        {"status": "Z", "reason": None},
        {"fraud_flag": "Y"},
    )
    for only in ("Revolver", None):
        keys = ["acct_id", "load_date"]
        merged = {r.acct_id: r for r in beh.monthly_history(df, only).collect()}
        parts = (
            df.select(*keys)
            .join(beh.revolver_months(df, only), keys, "left")
            .join(beh.monthly_fees(df).drop("month_end", *beh.FEE_PARTS), keys, "left")
            .join(beh.month_end_principal(df).drop("month_end"), keys, "left")
        )
        for r in parts.collect():
            mine = merged.get(r.acct_id)
            for c in parts.columns[2:]:
                assert (mine[c] if mine else None) == r[c], (r.acct_id, c)


def test_net_sales_drops_null_operands_per_sum(spark):
    d = date(2024, 2, 10)
    df = spark.createDataFrame(
        [
            (7, d, "Sale", 1, 100.0, 5.0, 5.0, -2.0, 1.0, 1.0),
            (7, d, "Other", 256, 50.0, 3.0, 4.0, -2.0, 1.0, None),
            (7, d, "Sale", 256, 10.0, None, 4.0, -2.0, None, 1.0),
            (8, d, "Other", 1, 10.0, 1.0, 1.0, None, None, None),
        ],
        "account_no bigint, as_of date, ttype string, tcode int, net_sale double, "
        "sales_adj double, interest_adj double, net_returns double, cash_regular double, "
        "cash_atm double",
    )
    got = {r.acct_id: tuple(r)[1:] for r in beh.net_sales(df).collect()}
    end = date(2024, 2, 29)
    assert got == {"7": (end, 103.0, 2.0, 105.0), "8": (end, 0.0, 0.0, 0.0)}


def test_max_mob_uses_qualifying_rows_only(spark):
    df = spark.createDataFrame(
        [("a", 3, " "), ("a", 30, "C"), ("b", 30, None), ("c", 25, "Z")],
        "account_id string, mob int, status string",
    )
    got = {(r.account_id, r.mob): (r.max_mob, r.mob_indicator) for r in beh.max_mob_indicator(df).collect()}
    assert got[("a", 30)] == (3, "Max MOB < 24")
    assert got[("b", 30)] == (None, "Max MOB >= 24")
    assert got[("c", 25)] == (25, "Max MOB >= 24")


def test_full_key_and_measure_sets(spark):
    full = beh.EnrichSpec(
        patterns=tuple(f"p{i}" for i in range(15)),
        balances=tuple(f"b{i}" for i in range(5)),
        counts=tuple(f"c{i}" for i in range(14)),
    )
    assert len(beh.panel_keys(full)) == 53
    assert len(beh.panel_measures()) == 37


def test_keyed_panel_gives_the_same_aggregate(spark):
    """Keys packed per report and application, among them rows without a report and without an application."""
    spec = beh.EnrichSpec()
    perf = spark.createDataFrame(
        [(str(i), i if i < 6 else None, D, i, 100.0 + i, 500.0, 400.0, "ZC "[i % 3], i % 2, 0, 0, None, D, D, "WEB", 50 * i)
         for i in range(8)],
        "account_id string, app_id long, period date, mob int, balance double, credit_line double, acq_line double, "
        "status string, dpd30 int, charge_off int, closure_flag int, closure_date date, entry_date date, book_month date, "
        "channel string, score int",
    )
    apps = spark.createDataFrame(
        [(i, f"R{i}", ["PRREVLR", "PRTRANS", None][i % 3], 10 * i, 20 * i, "T1" if i % 2 else None, 500 + 60 * i if i else None)
         for i in range(5)],
        "app_id long, report_id string, rv80 string, random02 int, random03 int, risk_tier string, vantage int",
    )
    names = [*spec.bureau_codes, *spec.patterns, *spec.balances, *spec.counts]
    types = ["string"] * 18 + ["double"] * 5 + ["string"] * 14
    rows = [
        (f"R{i}", *["PRREVLR", None, "PRMIXED"], *["RRT", "TTX", "-2", None, "RT"] * 3, *[1500.0 * i, -3.0, None, 5.0, 2000.0],
         *[f"{i * k:03d}" if k else None for k in range(14)])
        for i in range(4)
    ]
    bureau = spark.createDataFrame(rows, "report_id string, " + ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))
    txn = spark.createDataFrame(
        [(7, D, "Sale", 1, 100.0, 0.0, 0.0, -2.0, 1.0, None)],
        "account_no long, as_of date, ttype string, tcode int, net_sale double, sales_adj double, "
        "interest_adj double, net_returns double, cash_regular double, cash_atm double",
    )
    inputs = perf, apps, bureau, hist(spark, *[{}] * 8), txn
    hot = {"hot_accounts": NO_HOT_KEYS, "hot_apps": NO_HOT_KEYS}
    plain = beh.behaviour_aggregate(builds.build_panel(*inputs, **hot))
    keyed = beh.behaviour_aggregate(builds.build_panel(*inputs, **hot, keyed=True))
    assert keyed.dtypes == plain.dtypes
    got = sorted(keyed.collect(), key=str)
    assert len(got) == 8 and got == sorted(plain.collect(), key=str)
    # what a report and an application give is grouped by as their integers
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    groups = [x.split("]")[0] for x in plan.split("\n") if "Aggregate [__packed" in x]
    assert len(groups) == 1 and all(n in groups[0] for n in ("__marks0", "__report0", "__application0"))
