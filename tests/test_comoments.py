import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from vintage_panel.operators import comoments as cm
from vintage_panel.operators import screening as scr


def whole(x, y):
    """Moments of one pair over all rows, in exact fractions of the mean."""
    known = ~(np.isnan(x) | np.isnan(y))
    x, y = x[known].astype(np.longdouble), y[known].astype(np.longdouble)
    n = len(x)
    if not n:
        return 0, None, None, 0.0, 0.0, 0.0
    mx, my = x.mean(), y.mean()
    return n, mx, my, ((x - mx) ** 2).sum(), ((y - my) ** 2).sum(), ((x - mx) * (y - my)).sum()


def frame(rng, n, p):
    x = rng.normal(size=(n, p)) * 10.0 ** rng.integers(-3, 4, p) + 10.0 ** rng.integers(0, 7, p)
    x[rng.random((n, p)) < 0.15] = np.nan
    x[:, p // 2] = 4.2
    return x


@pytest.mark.parametrize("tile, held, fan_in", [(64, cm.HELD, 1024), (3, cm.HELD, 2), (5, 0, 2)])
def test_tiles_equal_pairs(spark, tile, held, fan_in):
    rng = np.random.default_rng(3)
    x = frame(rng, 700, 11)
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{k}" for k in range(11)])).repartition(7)
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")  # several batches a task
    try:
        rows = cm.pair_moments(df, tile, held, fan_in).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    assert sorted((r.i, r.j) for r in rows) == [(i, j) for i in range(11) for j in range(i + 1, 11)]
    for r in rows:
        n, mx, my, sxx, syy, sxy = whole(x[:, r.i], x[:, r.j])
        assert r.n == n and math.isclose(r.ax + r.mx, mx, rel_tol=1e-12) and math.isclose(r.ay + r.my, my, rel_tol=1e-12)
        scale = float((sxx * syy) ** 0.5)
        assert math.isclose(r.sxx, sxx, rel_tol=1e-8, abs_tol=1e-9) and math.isclose(r.syy, syy, rel_tol=1e-8, abs_tol=1e-9)
        assert math.isclose(r.sxy, sxy, rel_tol=1e-7, abs_tol=1e-8 * max(scale, 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(-1e6, 1e6), st.floats(-1e6, 1e6)), min_size=2, max_size=30), st.integers(0, 30))
def test_merge_in_any_split(rows, cut):
    x = np.array(rows)
    one = lambda part: np.array([[v] for v in _sums(part)]).reshape(len(cm.SUMS), 1)
    got = cm.merged(one(x[:cut]), one(x[cut:]))
    n, mx, my, sxx, syy, sxy = whole(x[:, 0], x[:, 1])
    assert got[0, 0] == n and np.allclose(got[1:3, 0] + got[3:5, 0], [float(mx), float(my)], atol=1e-6)
    assert np.allclose(got[5:8, 0], [float(sxx), float(syy), float(sxy)], rtol=1e-9, atol=1e-3)


def _sums(part):
    n, mx, my, sxx, syy, sxy = whole(part[:, 0], part[:, 1]) if len(part) else (0, 0, 0, 0, 0, 0)
    return [n, np.floor(mx), np.floor(my), mx - np.floor(mx), my - np.floor(my), sxx, syy, sxy, 0, 0]


def test_small_spread_on_a_large_mean_and_outliers(spark):
    """A plain sum of squares would lose the spread; one huge first value must not hide it either."""
    rng = np.random.default_rng(5)
    a = 1e9 + rng.normal(0, 1e-3, 3000)
    b = a * 2 + rng.normal(0, 1e-4, 3000)
    c = rng.normal(size=3000)
    c[0] = 1e12
    d = c * 3
    c0 = np.where(np.arange(3000) == 0, np.nan, c)
    pdf = pd.DataFrame({"a": a, "b": b, "c": c0, "d": d})
    got = {(r.left, r.right): r["corr"] for r in scr.correlation_pairs(spark.createDataFrame(pdf)).collect()}
    exact = float(np.corrcoef((a - 1e9), (b - 2e9))[0, 1])
    assert got["a", "b"] == pytest.approx(exact, abs=1e-9)
    assert got["c", "d"] == pytest.approx(1.0, abs=1e-6)


def test_infinity_spoils_its_own_pairs_only(spark):
    rows = [(float(i), float(2 * i), math.inf if i == 3 else float(-i), None if i == 3 else float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.left, r.right): r["corr"] for r in scr.correlation_pairs(df).collect()}
    assert got["a", "b"] == pytest.approx(1) and got["a", "d"] == pytest.approx(1)
    assert got["a", "c"] is None and got["b", "c"] is None
    assert got["c", "d"] == pytest.approx(-1)  # the infinity stands where d is unknown


def test_one_scan_and_no_rows(spark, tmp_path):
    spark.range(50).selectExpr("id a", "id * 2 b", "id % 7 c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = scr.correlation_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Coalesce" not in plan
    none = scr.correlation_pairs(df.filter("a < 0")).collect()
    assert len(none) in (0, 3) and all(r["corr"] is None for r in none)


def test_many_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 150))
    x[:, 149] = x[:, 3] * -2
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{k}" for k in range(150)])).repartition(3)
    assert [(r.left, r.right) for r in scr.correlation_pairs(df, above=0.999).collect()] == [("c3", "c149")]
