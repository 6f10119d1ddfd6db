"""Replacing stored tables, and builds over tables stored in buckets of the account."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from vintage_panel.operators import panel as pn
from vintage_panel.operators.skew import CO_LOCATED
from vintage_panel.operators.target import account_lookups, base_with_flags
from vintage_panel.sources import io


def failing(df):
    """Fails on one row, after the write has begun."""
    return df.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")))


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    spark.sql(f"create database stored location '{tmp_path_factory.mktemp('stored')}'")
    yield "stored"
    spark.sql("drop database stored cascade")


def test_replaced_folder(spark, tmp_path):
    path = str(tmp_path / "acct.parquet")
    first = io.materialize(spark.range(5), path)
    assert io.read_table(spark, str(tmp_path), "acct").count() == 5
    with pytest.raises(Exception, match="broken row"):
        io.materialize(failing(spark.range(9)), path)
    assert io.read_path(spark, path).count() == 5 and first.count() == 5
    # another schema, and from the table itself
    again = io.read_path(spark, path).select("id", F.lit("x").alias("c"))
    io.materialize(again.union(again), path)
    assert io.read_path(spark, path).columns == ["id", "c"]
    assert io.read_path(spark, path).count() == 10
    assert first.count() == 5  # a reader from before the switch goes on
    for n in (1, 2):
        io.materialize(spark.range(n), path)
    kept = [p.name for p in (tmp_path / "acct.parquet").iterdir() if p.name.startswith(io.VERSION)]
    assert len(kept) == 1 + io.PREVIOUS and io.read_path(spark, path).count() == 2
    assert not [p for p in (tmp_path / "acct.parquet").iterdir() if p.name.startswith(f"{io.POINTER}.")]


def test_partitioned_folder_and_plain_folder(spark, tmp_path):
    df = spark.range(10).withColumn("m", F.col("id") % 3)
    back = io.materialize(df, str(tmp_path / "p"), partition_by=["m"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    df.write.parquet(str(tmp_path / "plain"))
    assert io.read_path(spark, str(tmp_path / "plain")).count() == 10


def test_unfinished_version_is_not_pruned(spark, tmp_path):
    path = tmp_path / "acct"
    io.materialize(spark.range(1), str(path))
    other = path / f"{io.VERSION}{'0' * 20}-other"
    other.mkdir()  # another writer is still at work
    for n in (2, 3, 4):
        io.materialize(spark.range(n), str(path))
    assert other.exists() and io.read_path(spark, str(path)).count() == 4


def test_replaced_table(spark, database):
    name = f"{database}.flags"
    io.materialize(spark.range(4), name, as_table=True)
    before = spark.table(name)
    with pytest.raises(Exception, match="broken row"):
        io.materialize(failing(spark.range(9)), name, as_table=True)
    assert spark.table(name).count() == 4
    io.materialize(spark.table(name).selectExpr("id", "'a' as c"), name, as_table=True)
    assert spark.table(name).columns == ["id", "c"] and before.count() == 4
    for n in (1, 2):
        io.replace_table(spark.range(n), name)
    assert spark.table(name).count() == 2
    assert len(spark.catalog.listTables(database, "flags__*")) == 1 + io.PREVIOUS


def test_wrong_arguments(spark):
    with pytest.raises(ValueError):
        io.materialize(spark.range(1), as_table=True)
    with pytest.raises(ValueError):
        io.materialize(spark.range(1), "x", bucket_by="id")


KEY = "account_id"


def inputs(spark):
    accounts = [(f"{i:016d}", date(2023, 1 + i % 6, 28)) for i in range(60)]
    base = spark.createDataFrame([*accounts, (None, date(2023, 1, 28))], f"{KEY} string, book_vintage date")
    months = spark.range(30).select(F.col("id").cast("int").alias("mob"))
    rows = base.filter(F.col(KEY).isNotNull()).crossJoin(F.broadcast(months)).select(
        KEY, "mob", F.col("book_vintage").alias("open_date"), F.last_day(F.add_months("book_vintage", F.col("mob"))).alias("as_of"),
        F.xxhash64(KEY, "mob").alias("h"),
    )
    hist = rows.select(
        KEY, "mob", "as_of", F.when(F.col("h") % 31 == 0, "B").when(F.col("h") % 37 == 0, "Z").otherwise(" ").alias("status"),
        F.when(F.col("h") % 11 == 0, "46").when(F.col("h") % 13 == 0, "36").otherwise("00").alias("reason"),
        (F.col("h") % 1000).cast("double").alias("balance"),
    )
    snaps = rows.select(KEY, "as_of", "open_date", F.pmod("h", F.lit(140)).cast("int").alias("del_days"))
    return base, hist, snaps


def flags(base, hist, snaps, hot):
    found = account_lookups(
        base, key=KEY, hist=hist, shifts=hist,
        panel=pn.delinquency_panel(snaps, key=KEY, suffix=None),
    )
    return base_with_flags(base, found, key=KEY, hot=hot)


def balances(base, hist, hot):
    return pn.wide_panel(
        base, hist, key=KEY, start="book_vintage", as_of="as_of", value="balance", prefix="balance_t", missing=True, hot=hot
    )


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange \S+", plan)


def test_builds_over_buckets_move_no_rows(spark, database):
    plain = inputs(spark)
    names = ["base", "hist", "snaps"]
    for name, df in zip(names, plain, strict=True):
        io.replace_table(df, f"{database}.{name}", bucket_by=KEY, buckets=6)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large for it
    try:
        base, hist, snaps = [spark.table(f"{database}.{n}") for n in names]
        target, panel = flags(base, hist, snaps, CO_LOCATED), balances(base, hist, CO_LOCATED)
        assert exchanges(target) == [] and exchanges(panel) == []
        assert exchanges(flags(*plain, None)) != []  # what the buckets save
        for mine, other in ((target, flags(*plain, None)), (panel, balances(plain[0], plain[1], None))):
            assert sorted(map(str, mine.collect())) == sorted(map(str, other.collect()))
            assert mine.count() == 61
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
