from datetime import date

import pytest
from pyspark.sql import functions as F

from vintage_panel.operators import lookups as lk
from vintage_panel.operators.skew import NO_HOT_KEYS, expanding_join, hot_keys, lookup_join


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some without a key."""
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k"),
        F.col("id").alias("v"),
    )
    right = left.select("k").distinct().withColumn("w", F.length("k"))
    return left, right


def test_hot_keys_follow_from_the_rows_per_task(spark, skewed):
    left, _ = skewed
    assert rows(hot_keys(left, "k", 100)) == [("hot", 3)]
    assert rows(hot_keys(left, "k", 299)) == [("hot", 2)]
    assert rows(hot_keys(left, "k", 300)) == []
    assert rows(hot_keys(left.limit(0), "k")) == []


def test_salted_join_equals_plain_join(spark, skewed):
    left, right = skewed
    # a right side with several rows per key multiplies as a plain join does
    for other in (right, right.union(right)):
        for hot in (None, NO_HOT_KEYS, hot_keys(left, "k", 20)):
            assert rows(lookup_join(left, other, "k", hot=hot)) == rows(left.join(other, "k", "left"))


def test_numeric_keys_never_meet_a_stand_in(spark):
    left = spark.range(200).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 2**31, 2**22).union(spark.range(200)).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    assert rows(lookup_join(left, right, "k")) == rows(left.join(right, "k", "left"))


def test_expanding_join_equals_plain_join(spark, skewed):
    many, _ = skewed
    few = many.select("k").distinct().union(spark.createDataFrame([("absent",), (None,)], "k string"))
    few = few.withColumn("w", F.length("k"))
    for per_task in (20, 10**6):
        got = expanding_join(few, many, "k", hot=hot_keys(many, "k", per_task))
        assert rows(got) == rows(few.join(many, "k", "left"))


def test_hot_key_and_absent_keys_are_spread(spark, skewed):
    left, right = skewed
    half = left.withColumn("k", F.when(F.col("v") % 2 == 0, F.col("k")))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        def largest(df, keep):
            placed = df.withColumn("p", F.spark_partition_id())  # keeps the filter above the join
            parts = placed.filter(keep).groupBy("p").agg(F.count("v").alias("n"), F.count("w"))
            return max(r["n"] for r in parts.collect())

        hot = F.col("k") == "hot"
        assert largest(left.join(right, "k", "left"), hot) == 300
        assert largest(lookup_join(left, right, "k", hot=hot_keys(left, "k", 30)), hot) < 150
        assert largest(half.join(right, "k", "left"), F.col("k").isNull()) > 400
        assert largest(lookup_join(half, right, "k", hot=NO_HOT_KEYS), F.col("k").isNull()) < 60
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ever_flag(spark):
    base = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    hist = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), (None, 1)], "k string, x int")
    got = lk.ever_flag(base, hist, "k", F.col("x") == 1, "f")
    assert rows(got) == rows(spark.createDataFrame([("a", 1), ("b", 0), (None, 0)], "k string, f int"))


def test_disputed_accounts_counts_all_cases_of_listed_accounts(spark):
    d = date(2024, 1, 1)
    cases = spark.createDataFrame(
        [
            ("1", d, "03", "N", 10.0, 1.0),
            ("1", date(2024, 5, 1), "99", "Y", 5.0, 2.0),  # not listed itself, still counted
            ("2", d, "03", "N", 7.0, 0.0),  # filed wrongly
            ("3", d, "03", "Y", 7.0, 0.0),  # not listed
            ("4", d, "03", "N", 3.0, None),  # unmarked
            ("5", d, "03", "N", 4.0, 4.0),  # one wrong and one right mark
        ],
        "account_id string, reported date, type_cd string, in_db string, disputed double, chargeoff double",
    )
    marks = spark.createDataFrame(
        [(1, False), (2, True), (4, None), (5, True), (5, False)],
        "account_no bigint, filed_incorrectly boolean",
    )
    got = lk.disputed_accounts(cases, marks).orderBy("account_id").collect()
    assert [(r[0], r.reported, r.disputed, r.chargeoff) for r in got] == [
        ("1", date(2024, 5, 1), 15.0, 3.0),
        ("4", d, 3.0, None),
        ("5", d, 4.0, 4.0),
    ]


def test_latest_nonnull_keeps_every_row_of_the_day(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, 1.0, 1.0), ("a", 2, None, 3.0), ("a", 2, 2.0, 2.0), ("a", 2, 2.0, 2.0),
            ("a", 3, None, None), ("b", 1, None, None),
        ],
        "k string, d int, x double, y double",
    )
    assert rows(lk.latest_nonnull_date(df, "k", "d", ["x", "y"])) == [("a", 2)]
    got = lk.latest_nonnull_rows(df, "k", "d", ["x", "y"], "t")
    assert rows(got) == [("a", 2, 4.0), ("a", 2, None)]


def test_suffix_and_cast_keys(spark):
    left = spark.createDataFrame([("0000000000000012",), ("0000000000000099",)], "k string")
    right = spark.createDataFrame([("99990000000000000012", 5)], "full string, v int")
    got = {r.k: r.v for r in lk.join_on_suffix(left, right, "k", "full").collect()}
    assert got == {"0000000000000012": 5, "0000000000000099": None}
    ids = spark.createDataFrame([("12",), ("012",)], "k string")
    marks = spark.createDataFrame([(12, "m")], "n bigint, v string")
    got = {r.k: r.v for r in lk.join_on_cast_key(ids, marks, "k", "n").collect()}
    assert got == {"12": "m", "012": None}
