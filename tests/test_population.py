from datetime import date

from pyspark.sql import functions as F

from vintage_panel.operators.population import (
    PopulationSpec,
    first_per_key,
    latest_per_key,
    population,
)
from vintage_panel.operators.rules import (
    RULES,
    any_flag,
    apply_rules,
    exclude,
    exclusion_rules,
    flag_names,
)
from vintage_panel.sources.io import date_window, materialize, shared_dir

APPS = "app_id int, ext_id string, created date, account_id string"


def test_dedupe_comes_before_the_filters(spark):
    apps = spark.createDataFrame(
        [
            (1, "a", date(2023, 1, 5), "A"),
            (2, "a", date(2025, 1, 5), "A2"),  # newest is outside the window
            (3, "b", date(2023, 2, 5), "B"),
            (4, "b", date(2023, 3, 5), None),  # newest is not booked
            (5, "c", date(2023, 4, 5), "C"),
            (6, "c", date(2023, 4, 5), "C2"),  # tie on the date
            (7, "d", date(2024, 3, 31), "D"),  # the end day is outside
            (8, None, date(2023, 1, 1), "N"),
        ],
        APPS,
    )
    got = {(r.app_id, r.vintage_month) for r in population(apps).collect()}
    assert got == {(6, "2023-04"), (8, "2023-01")}


def test_first_and_latest(spark):
    df = spark.createDataFrame([("k", 1, 1), ("k", 1, 2), ("k", 3, 1)], "k string, d int, t int")
    assert tuple(first_per_key(df, ["k"], "d", ["t"]).first()) == ("k", 1, 1)
    assert tuple(latest_per_key(df, ["k"], "d", ["t"]).first()) == ("k", 3, 1)


def test_top_row_is_kept_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("d"))
    plan = latest_per_key(df, ["k"], "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_population_projects_before_the_window(spark, tmp_path):
    wide = spark.range(10).select(
        F.col("id").alias("app_id"),
        F.col("id").cast("string").alias("ext_id"),
        F.lit(date(2023, 1, 1)).alias("created"),
        F.col("id").cast("string").alias("account_id"),
        F.lit("x").alias("unused"),
    )
    wide.write.parquet(str(tmp_path / "apps"))
    apps = spark.read.parquet(str(tmp_path / "apps"))
    out = population(apps, PopulationSpec(columns=("app_id", "account_id")))
    assert "unused" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == ["app_id", "account_id", "vintage_month"]


def test_date_window_ends(spark):
    days = [date(2023, 1, 1), date(2023, 1, 2), date(2023, 1, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert date_window(df, "d", days[0], days[2]).count() == 2
    assert date_window(df, "d", days[0], days[2], closed="both").count() == 3
    assert date_window(df, "d", days[1]).count() == 2


def test_materialize_round_trip(spark):
    df = spark.createDataFrame([(1, date(2024, 2, 29), None)], "a int, b date, c string")
    back = materialize(df)
    assert back.schema == df.schema and back.collect() == df.collect()
    assert shared_dir(spark)


RULE_SCHEMA = (
    "id int, decline_code string, income double, fico double, vantage double, open_trades string, "
    "total_trades string, oldest_trade_months string, bureau_months string, "
    "bankruptcy_months string, chargeoff_months string, is_test boolean, fraud_suspect string, "
    "ever_fraud int, synthetic_third_date date, fraud_app_ind int"
)
CLEAN = (None, 9000.0, 700.0, 700.0, "003", "010", "050", "060", None, None, False, "Non Fraud",
         0, None, 0)


def row(i, **change):
    names = [c.split()[0] for c in RULE_SCHEMA.split(", ")][1:]
    return (i, *[change.get(n, v) for n, v in zip(names, CLEAN)])


def test_rules_and_null_handling(spark):
    rows = [
        row(0),
        row(1, income=None, fraud_suspect=None, is_test=None, total_trades=None),
        row(2, fico=None, vantage=None),
        row(3, fico=299.0, vantage=299.5),  # 299.5 rounds to 300, still low
        row(4, fico=851.0),
        row(5, bankruptcy_months="007"),
        row(6, open_trades=None, oldest_trade_months=None, bureau_months="012"),
        row(7, decline_code="K00020", chargeoff_months="005"),
        row(8, synthetic_third_date=date(2024, 1, 1), ever_fraud=1, fraud_app_ind=1),
    ]
    df = spark.createDataFrame(rows, RULE_SCHEMA)
    rules = exclusion_rules()
    assert tuple(rules) == RULES and len(RULES) == 25
    out = apply_rules(df, rules)
    got = {
        r.id: {n[5:] for n in flag_names() if r[n] == 1}
        for r in out.collect()
    }
    assert got == {
        0: set(),
        1: set(),
        2: {"invalid_fico", "invalid_vantage"},
        3: {"invalid_fico", "low_fico", "low_vantage"},
        4: {"invalid_fico"},
        5: {"fraud_alert", "recent_bankruptcy"},
        6: {"no_open_trade", "thin_oldest_trade", "thin_bureau"},
        7: {"dob_mismatch"},
        8: {"synthetic_3rd", "ever_fraud_co", "fraud_app"},
    }
    total = {r.id: r.global_exclusion for r in out.collect()}
    assert total == {i: int(bool(f)) for i, f in got.items()}
    assert {r.id for r in exclude(out).collect()} == {0, 1}
    again = any_flag(out, ["excl_low_fico", "excl_invalid_fico"], "score_issue")
    assert {r.id for r in again.collect() if r.score_issue == 1} == {2, 3, 4}
