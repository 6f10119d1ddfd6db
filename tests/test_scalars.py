"""Edge rows of the scalar rules."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from vintage_panel.functions import codes
from vintage_panel.functions.dates import is_month_end, month_diff, month_end_after, year_quarter
from vintage_panel.functions.scalars import (
    as_int,
    band,
    date_band_rate,
    dpd_columns,
    event_mob,
    padded_int,
    pattern_tag,
    score_fallback,
    threshold_flag,
)
from vintage_panel.operators.behaviour import line_segment, mob_indicator
from vintage_panel.operators.lookups import acquisition_cost


def values(spark, schema, rows, expr):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_month_diff_counts_boundaries(spark):
    rows = [
        (date(2022, 2, 1), date(2022, 1, 31)),
        (date(2022, 1, 31), date(2022, 1, 1)),
        (date(2023, 1, 1), date(2022, 12, 31)),
        (date(2022, 12, 31), date(2023, 1, 1)),
        (None, date(2022, 1, 1)),
    ]
    got = values(spark, "a date, b date", rows, month_diff(F.col("a"), F.col("b")))
    assert got == [1, 0, 1, -1, None]


def test_month_ends(spark):
    rows = [(date(2024, 2, 29),), (date(2023, 2, 28),), (date(2024, 2, 28),)]
    assert values(spark, "d date", rows, is_month_end(F.col("d"))) == [True, True, False]
    got = values(spark, "d date", rows, month_end_after(F.col("d"), 1))
    assert got == [date(2024, 3, 31), date(2023, 3, 31), date(2024, 3, 31)]


def test_year_quarter(spark):
    label = year_quarter(F.col("d"))[2]
    assert values(spark, "d date", [(date(2024, 8, 1),), (None,)], label) == ["2024Q3", None]


def test_dpd_floor_keeps_null(spark):
    cols = dpd_columns(F.col("d"))
    expr = F.struct(cols["dpd"].alias("dpd"), cols["dpd15plus"].alias("a"), cols["dpd90plus"].alias("b"))
    got = values(spark, "d int", [(None,), (28,), (29,), (44,), (119,)], expr)
    assert [tuple(r) for r in got] == [
        (None, 0, 0), (0, 0, 0), (0, 0, 0), (15, 1, 0), (90, 1, 1),
    ]


def test_pattern_tag(spark):
    rows = [(None,), ("",), ("-2",), ("RRTT",), ("TTTR",), ("R--T",), ("XXXX",), ("TT-X",)]
    got = values(spark, "p string", rows, pattern_tag(F.col("p")))
    mixed = "Mixed Behavior"
    assert got == [mixed, mixed, mixed, "Revolver", "Transactor", mixed, mixed, "Transactor"]


def test_threshold_flag(spark):
    rows = [(-1.0,), (None,), (0.0,), (1000.0,), (1000.01,)]
    assert values(spark, "x double", rows, threshold_flag(F.col("x"))) == [None, None, 0, 0, 1]


def test_event_mob(spark):
    expr = event_mob(F.col("a"), F.col("b"), F.col("c"))
    rows = [(20, 5, None), (None, 7, 3), (None, None, None), (None, None, 9)]
    assert values(spark, "a int, b int, c int", rows, expr) == [20, 3, 99, 9]


def test_integer_casts(spark):
    assert values(spark, "x double", [(2.5,), (299.5,), (-2.5,)], as_int(F.col("x"), True)) == [3, 300, -3]
    assert values(spark, "x string", [("007",), (None,)], padded_int(F.col("x"))) == [7, None]
    assert values(spark, "x string", [("x7",)], padded_int(F.col("x"), strict=False)) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, "x string", [("x7",)], padded_int(F.col("x")))


def test_bands(spark):
    rows = [(None,), (579.0,), (580.0,), (599.0,), (599.5,), (600.0,), (660.0,)]
    four = band(F.col("x"), codes.SCORE_BANDS_4, codes.SCORE_BANDS_4_DEFAULT)
    assert values(spark, "x double", rows, four) == [
        "5. Check", "4. SubPrime <580", "3. Sub Prime", "3. Sub Prime", "5. Check",
        "2. Near Prime", "1. Prime+",
    ]
    credit = band(F.col("x"), codes.CREDIT_BANDS, codes.CREDIT_BANDS_DEFAULT)
    assert values(spark, "x double", rows, credit)[:2] == ["4. Check", "4. Check"]


def test_line_segment_regimes(spark):
    d1, d2 = date(2025, 7, 1), date(2025, 7, 2)
    rows = [(85.0, d1), (85.5, d1), (70.0, d1), (85.0, d2), (85.5, d2), (95.0, d2), (95.0, None)]
    got = values(spark, "b double, d date", rows, line_segment(F.col("b"), F.col("d")))
    assert got == ["1.L Line", "2.H Line", "3.BAU Line", "1.L Line", "1.L Line", "2.H Line", "3.BAU Line"]


def test_score_fallback(spark):
    rows = [(5, 7), (0, 7), (-1, None), (None, 0), (None, 3)]
    assert values(spark, "a int, b int", rows, score_fallback(F.col("a"), F.col("b"))) == [5, 7, None, None, 3]


def test_rates_are_double_precise(spark):
    expr = date_band_rate(F.col("d"), codes.OPEX_RATES, codes.OPEX_DEFAULT)
    rows = [(date(2022, 12, 31),), (date(2024, 1, 1),), (date(1999, 1, 1),), (None,)]
    assert values(spark, "d date", rows, expr) == [-0.082 / 12, -0.064 / 12, -0.049 / 12, -0.049 / 12]


def test_acquisition_cost(spark):
    rows = [("Direct Mail", 2023), ("Direct Mail", 2030), ("CK Lightbox", None), ("Other Channels", 2023), (None, 2023)]
    got = values(spark, "c string, y int", rows, acquisition_cost(F.col("c"), F.col("y")))
    assert got == [82.0, 102.7, 73.0, 5.0, 5.0]


def test_mob_indicator_null_is_complete(spark):
    got = values(spark, "m int", [(23,), (24,), (None,)], mob_indicator(F.col("m")))
    assert got == ["Max MOB < 24", "Max MOB >= 24", "Max MOB >= 24"]
