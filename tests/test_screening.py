import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vintage_panel.operators import screening as scr
from vintage_panel.operators import segments as seg
from vintage_panel.operators import woe


def test_number_parsing(spark):
    texts = ["1", " 2.5 ", "1e3", "1d", "1f", "2.D", "x", "", None, "-7", "NaN", "12 34"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(scr.parse_number(F.col("s"))).collect()]
    assert got == [1.0, 2.5, 1000.0, None, None, None, None, None, None, -7.0, None, None]


def test_coercion_needs_more_than_the_share(spark):
    df = spark.createDataFrame(
        [(str(i), str(i) if i < 8 else "x", str(i) if i < 9 else "x", None) for i in range(10)],
        "a string, eight string, nine string, empty string",
    )
    out = scr.coerce_numeric(df, 0.8)
    assert dict(out.dtypes) == {"a": "double", "eight": "string", "nine": "double", "empty": "string"}
    verdict = {r["column"]: r["numeric"] for r in scr.numeric_shares(df).collect()}
    assert verdict == {"a": True, "eight": False, "nine": True, "empty": False}


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.floats(allow_nan=False, allow_infinity=False, width=32),
            st.sampled_from([1e-300, 1e300, 1.7e308, -1.7e308, math.inf, -math.inf]),
            st.integers(-3, 3).map(float),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_exact_median(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    ranked = sorted(xs)
    ends = ranked[(len(xs) - 1) // 2], ranked[len(xs) // 2]
    want = ends[0] if ends[0] == ends[1] else ends[0] / 2 + ends[1] / 2
    got = scr.exact_median(df, "x")
    assert got == pytest.approx(want, rel=1e-12, abs=0) or (math.isnan(got) and math.isnan(want))


def test_median_of_nothing(spark):
    assert scr.exact_median(spark.createDataFrame([(None,)], "x double"), "x") is None


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(7)
    n = 400
    a = rng.normal(1e6, 1.0, n)  # large mean, small spread
    pdf = pd.DataFrame(
        {
            "a": a, "b": a + rng.normal(0, 0.01, n), "c": rng.normal(0, 1, n),
            "d": rng.integers(0, 5, n).astype(float), "e": 1.0,
        }
    )
    pdf["f"] = pdf["b"] * 2
    pdf.loc[::7, "c"] = np.nan
    pdf.loc[::5, "f"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf.columns]), pdf


def test_correlation_matches_pandas(numbers):
    df, pdf = numbers
    expected = pdf.corr()
    rows = scr.correlation_pairs(df).collect()
    assert len(rows) == 15
    for r in rows:
        want = expected.loc[r.left, r.right]
        if math.isnan(want):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(want, abs=1e-7)


def test_constants_have_no_correlation(spark):
    """Also a column that is constant only where the other is known, and one far from 0."""
    rows = [(float(i), 7.3 if i < 50 else float(i), float(i * i) if i < 50 else None, 1e9 + i * 1e-3) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, hush double, some double, far double")
    got = {(r.left, r.right): r["corr"] for r in scr.correlation_pairs(df).collect()}
    assert got["hush", "some"] is None
    assert got["a", "far"] == pytest.approx(1.0, abs=1e-6)
    assert {(r.left, r.right) for r in scr.correlation_pairs(df, above=0.99).collect()} == {("a", "far")}


def test_correlation_prune_is_not_greedy(numbers):
    df, _ = numbers
    # f is close to b, which is itself dropped for a
    assert scr.correlation_prune(df, 0.95).columns == ["a", "c", "d", "e"]
    assert scr.correlation_prune(df, 0.95, protected=["f"]).columns == ["a", "c", "d", "e", "f"]
    assert scr.correlation_prune(df, 0.95, target="a").columns == ["a", "b", "c", "d", "e"]


@pytest.mark.parametrize("distinct", [49, 50, 51, 120, 5000])
def test_cardinality_limit_is_exact(spark, distinct):
    df = spark.range(6000).select((F.col("id") % distinct).cast("string").alias("x"))
    assert scr.high_cardinality(df, 50) == (["x"] if distinct > 50 else [])
    assert scr.low_cardinality(df, ["x"], 50) == ({} if distinct > 50 else {"x": distinct})


def test_sketch_never_rules_out_a_column_within_the_limit():
    for limit in [*range(1, 300), 1000, 50_000]:
        registers = 2 ** math.ceil(2 * math.log2(1.106 / scr.sketch_error(limit)))
        worst = registers * math.log(registers / (registers - limit))
        assert worst < 2 * limit
        assert not scr._sketch_proves_more(math.ceil(worst), limit)


def test_name_rules():
    names = ["approval_code", "Perf_Date", "is_open", "This", "account_id", "price", "IDScore"]
    assert scr.name_rules(names, names=["idscore"]) == [
        "approval_code", "Perf_Date", "is_open", "account_id", "IDScore",
    ]


def test_clean_features_order_and_protection(spark):
    n = 60
    pdf = pd.DataFrame(
        {
            "y": [i % 2 for i in range(n)],
            "num": [float(i) for i in range(n)],
            "twin": [float(2 * i) for i in range(n)],
            "kept_twin": [float(3 * i) for i in range(n)],
            "text_num": [str(i) if i % 10 else "bad" for i in range(n)],
            "mostly_text": [str(i) if i % 2 else "bad" for i in range(n)],
            "sparse": ["a" if i < 10 else None for i in range(n)],
            "ids": [f"id{i}" for i in range(n)],
            "level": [f"l{i % 3}" for i in range(n)],
            "forced": [float((i * 7) % 11) for i in range(n)],
            "noise": [float((i * 37) % 17) for i in range(n)],
        }
    )
    df = spark.createDataFrame(pdf)
    spec = scr.CleanSpec(
        missing=0.3, protected=("kept_twin",), drop_categorical=False, cardinality=50, target="y",
        force_drop=("forced", "y"),
    )
    out, log = scr.clean_features(df, spec)
    dropped = {}
    for r in log.collect():
        dropped.setdefault(r["rule"], []).append(r["column"])
    assert dropped == {
        "protected": ["KEPT_TWIN", "Y"],
        "force_dropped": ["FORCED"],
        "high_missing": ["SPARSE"],
        "high_cardinality": ["IDS"],
        "high_correlation": ["TWIN", "TEXT_NUM"],
    }
    assert out.columns == ["Y", "NUM", "KEPT_TWIN", "MOSTLY_TEXT", "LEVEL", "NOISE"]
    assert out.count() == n
    strict, _ = scr.clean_features(df, scr.CleanSpec(cardinality=50, target="y"))
    assert "LEVEL" not in strict.columns


def test_target_summary(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,), (2.0,)], "x double")
    r = scr.target_summary(df, "x").first()
    assert (r.observations, r.missing, r.median, r.min, r.max) == (4, 1, 2.0, 1.0, 4.0)
    assert r["std"] == pytest.approx(np.std([1, 4, 2], ddof=1))
    levels = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    got = [tuple(r) for r in scr.target_summary(levels, "x").collect()]
    assert got == [("a", 2, 0.5), ("b", 1, 0.25)]


# ---------------------------------------------------------------- weight of evidence
def test_woe_by_hand(spark):
    """10 rows of class 0 and 5 of class 1: a has 6 and 1, b has 3 and 3, Missing has 1 and 1."""
    rows = [("a", 0)] * 6 + [("a", 1)] + [("b", 0)] * 3 + [("b", 1)] * 3 + [(None, 0), (None, 1)]
    df = spark.createDataFrame([(*r, "k", f"m{i}") for i, r in enumerate(rows)], "f string, y int, one string, many string")
    want = {
        "a": math.log(0.65 / 0.3),  # (6 + .5) / 10 over (1 + .5) / 5
        "b": math.log(0.35 / 0.7),
        "Missing": math.log(0.15 / 0.3),
    }
    iv = 0.35 * want["a"] - 0.35 * want["b"] - 0.15 * want["Missing"]
    table = woe.woe_table(df, ["f"], "y").collect()
    assert {r.level: r.woe for r in table} == pytest.approx(want)
    assert sum(r.iv for r in table) == pytest.approx(iv)
    ranking = woe.iv_ranking(df, "y", max_levels=10).collect()
    assert [r.feature for r in ranking] == ["f", "one"] and ranking[1].strength == "Useless"
    assert [r.feature for r in woe.iv_ranking(df, "y", ignore=["F"], max_levels=10).collect()] == ["one"]
    assert tuple(woe.woe_summary(df, "y", ignore=["f"], max_levels=10).first()) == (3, 1, 2)
    for r in woe.woe_transform(df, "y", features=["f"]).collect():
        assert r.f_woe == pytest.approx(want[r.f or "Missing"])
    with pytest.raises(ValueError, match="many"):
        woe.woe_transform(df, "y", features=["f", "many"], max_levels=10)


def test_one_class_target(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "f string, y int")
    assert {(r.woe, r.iv) for r in woe.woe_table(df, ["f"], "y").collect()} == {(None, 0.0)}
    assert [tuple(r) for r in woe.iv_ranking(df, "y").collect()] == [("f", 0.0, "Useless")]
    assert {r.f_woe for r in woe.woe_transform(df, "y").collect()} == {0.0}


def test_no_eligible_feature_gives_an_empty_ranking(spark):
    df = spark.createDataFrame([(1.0, 1)], "x double, y int")
    assert woe.iv_ranking(df, "y").collect() == []


def test_fifty_levels_pass_and_fifty_one_do_not(spark):
    for n, expected in ((50, ["f"]), (51, [])):
        rows = [(f"l{i % n}", i % 2) for i in range(4 * n)] + [(None, 1)]
        df = spark.createDataFrame(rows, "f string, y int")
        assert woe.eligible(df, "y") == expected


# ---------------------------------------------------------------- segments
def test_segment_edges(spark):
    agg = spark.createDataFrame(
        [
            (0, None, "R", 1, 2, 10.0, 20.0),
            (0, " ", "T", 0, 0, 0.0, 0.0),
            (2, " ", "R", 1, 1, 5.0, 5.0),
            (2, "Z", "R", 9, 9, 9.0, 9.0),
            (24, " ", "R", 9, 9, 9.0, 9.0),
            (2, " ", None, 3, 3, 3.0, 3.0),
        ],
        "mob int, status string, v string, rvl_unit int, tot_nz_unit int, tot_rvl_dollar double, "
        "tot_nz_dollar double",
    ).withColumn("book_month", F.current_date())
    base = seg.segment_base(agg, ["v"])
    assert base.count() == 4
    rates = seg.segment_rates(base, ["v"])
    got = {(r.mob, r.level): (r.unit_rate, r.dollar_rate) for r in rates.collect()}
    assert got == {(0, "R"): (0.5, 0.5), (0, "T"): (None, None), (2, "R"): (1.0, 1.0)}
    pivot = {r.mob: (r["R"], r["T"]) for r in seg.volume_pivot(rates, ["R", "T"], hi=3).collect()}
    assert pivot == {0: (2.0, 0.0), 1: (0.0, 0.0), 2: (1.0, 0.0), 3: (0.0, 0.0)}
    avg = seg.weighted_average(rates, {"unit_rate": "tot_nz_unit"}).first()
    assert avg.avg_unit_rate == pytest.approx(2 / 3)
    last = {r.level: (r.last_mob, r.unit_rate) for r in seg.last_observation(rates).collect()}
    assert last == {"R": (2, 1.0), "T": (0, None)}
    shot = seg.segment_snapshots(base, ["v"], [0]).drop("mob")
    assert sum(r.acct_mix for r in shot.collect()) == pytest.approx(1.0)
    matrix = seg.segment_matrix(shot, ["v"], ["T", "X", "R"]).collect()
    assert [r.level for r in matrix[:3]] == ["T", "X", "R"] and matrix[1]["v"] is None
    levels = spark.createDataFrame([("b",), ("T",), ("a",), ("R",)], "level string")
    assert [r.level for r in seg.ordered_levels(levels, ["T", "R"]).collect()] == ["T", "R", "a", "b"]
