import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from vintage_panel.operators import selection as sel
from vintage_panel.operators import screening as scr

doubles = st.floats(allow_nan=False)


@given(doubles, doubles)
def test_images_sort_like_doubles(a, b):
    x, y = (int(v) for v in sel.image(np.array([a, b])))
    assert (x < y) == (a < b) and (x == y) == (a == b)
    assert sel.value(x) == a


def test_image_of_special_values():
    xs = [-math.inf, -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.7e308, math.inf]
    images = [int(v) for v in sel.image(np.array(xs))]
    assert images == sorted(images) and len(set(images)) == len(xs)
    assert [sel.value(v) for v in images] == xs


@pytest.mark.parametrize("parts, batch", [(1, 10_000), (9, 17)])
def test_many_columns_at_once(spark, monkeypatch, parts, batch):
    rng = np.random.default_rng(2)
    n = 501
    pdf = pd.DataFrame(
        {
            "narrow": 1e9 + rng.normal(0, 1e-3, n), "wide": rng.normal(size=n) * 10.0 ** rng.integers(-300, 300, n),
            "ties": rng.integers(0, 3, n).astype(float), "one": 7.25, "signs": rng.choice([-0.0, 0.0, -1.0], n),
            "half": np.where(np.arange(n) % 2, 1.0, 2.0),
        }
    )
    pdf.loc[::9, "narrow"] = np.nan
    pdf.loc[::2, "wide"] = np.nan
    df = spark.createDataFrame(pdf).repartition(parts)
    df = df.withColumn("none", F.lit(None).cast("double")).withColumn("few", F.when(F.col("ties") == -1, 1))
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = dict(zip(df.columns, sel.summaries(df, [F.col(c) for c in df.columns]), strict=True))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    for name in pdf:
        s, x = got[name], pdf[name].dropna()
        assert (s.rows, s.known, s.low, s.high) == (n, len(x), x.min(), x.max())
        assert s.median == x.median()
        if name != "wide":
            assert s.mean == pytest.approx(x.mean(), rel=1e-12)
            assert s.std == pytest.approx((x - x.iloc[0]).std(), rel=1e-9, abs=1e-12)
    assert got["none"] == got["few"] == sel.Summary(rows=n)


def test_four_scans(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id * 37 % 1000 as double) / 7 as x").write.parquet(str(tmp_path / "t"))
    one_pass, scans = sel._one_pass, []
    try:
        sel._one_pass = lambda *a: scans.append(1) or one_pass(*a)
        r = scr.target_summary(spark.read.parquet(str(tmp_path / "t")), "x").first()
    finally:
        sel._one_pass = one_pass
    assert len(scans) == 4
    assert r["median"] == pytest.approx((499 / 7 + 500 / 7) / 2) and (r["min"], r["max"]) == (0.0, 999 / 7)


def test_no_rows_and_one_row(spark):
    df = spark.createDataFrame([], "x double")
    assert tuple(scr.target_summary(df, "x").first()) == (0, None, None, None, None, None, None)
    one = spark.createDataFrame([(2,)], "x int")
    assert tuple(scr.target_summary(one, "x").first()) == (1, 0, 2.0, 2.0, None, 2.0, 2.0)
