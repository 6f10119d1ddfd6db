from datetime import date

import pytest
from pyspark.sql import functions as F

from vintage_panel.functions.packing import Code, Day, Label, Number, Packing
from vintage_panel.operators import behaviour as beh

FIELDS = {
    "label": Label(("x", "y", "a long label", "", "it's \\ odd")),
    "small": Number(4, -3),
    "large": Number(63, -(2**61), "bigint"),
    "day": Day(),
    "code": Code(),
    "flag": Number(2),
}
ROWS = [
    ("x", -3, -(2**61), date(1, 1, 1), "", 0),
    ("", 11, 2**61, date(9999, 12, 31), "1234567", 1),
    (None, None, None, None, None, None),
    ("a long label", 0, 0, date(1970, 1, 1), "\0", 2),
    ("y", 5, -1, date(2024, 2, 29), "é€ä", 1),
    ("y", 5, -1, date(2024, 2, 29), " ", 1),
    ("it's \\ odd", 5, -1, date(2024, 2, 29), " ", 1),
]
SCHEMA = "label string, small int, large bigint, day date, code string, flag int"


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    packing = Packing(FIELDS)
    words = df.select(*packing.columns())
    assert {t for _, t in words.dtypes} == {"bigint"} and words.distinct().count() == len(ROWS)
    assert all(v >= 0 for r in words.collect() for v in r)
    back = words.select(*packing.unfolded())
    assert back.dtypes == df.dtypes
    assert [tuple(r) for r in back.collect()] == ROWS


@pytest.mark.parametrize(
    "field, value, type",
    [(Label(("x",)), "y", "string"), (Number(4), 15, "int"), (Number(4), -1, "int"), (Code(), "12345678", "string")],
)
def test_what_does_not_fit_raises(spark, field, value, type):
    df = spark.createDataFrame([(value,)], f"my_key {type}")
    packing = Packing({"my_key": field})
    with pytest.raises(Exception, match="my_key"):
        df.select(*packing.columns()).collect()


def test_fields_share_integers():
    packing = Packing({f"f{k}": Number(20) for k in range(7)})
    assert len(packing.names) == 3
    with pytest.raises(ValueError):
        Packing({"f": Number(64)})


def test_aggregate_by_packed_keys(spark):
    rows = [(f"l{i % 3}" if i % 4 else None, i % 5, f"c{i % 2}", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "lab string, num int, other string, v double")
    keys = {n: F.col(n) for n in ("lab", "num", "other")}
    measures = {"total": F.sum("v"), "n": F.count(F.lit(1))}
    plain = beh.behaviour_aggregate(df, keys, measures)
    fields = {"lab": Label(("l0", "l1", "l2")), "num": Number(4)}
    packed = beh.behaviour_aggregate(df, keys, measures, ["lab", "num", "other"], fields=fields)
    assert packed.dtypes == plain.dtypes
    assert packed.collect() == plain.orderBy("lab", "num", "other").collect()
    assert "Sort" not in plain._jdf.queryExecution().executedPlan().toString()


def test_no_text_key_in_the_exchange(spark):
    """All 53 keys travel as ten integers and the credit line."""
    keys = beh.panel_keys()
    fields = beh.panel_fields()
    left_out = {"year", "quarter", "year_quarter", "perf_year", "credit_line"}
    assert set(fields) == set(keys) - left_out
    assert len(Packing(fields | {"__entered": Number(16)}).names) <= 10
