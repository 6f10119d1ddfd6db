"""Panels and target against plain per-account Python."""

from datetime import date
from itertools import product

import pytest
from pyspark.sql import functions as F

from vintage_panel.operators import panel as pn
from vintage_panel.operators import qc
from vintage_panel.operators.target import (
    COMPONENTS,
    account_lookups,
    base_with_flags,
    model_target,
)


def month_end(base_year, k):
    import calendar

    y, m = base_year + k // 12, k % 12 + 1
    return date(y, m, calendar.monthrange(y, m)[1])


HIST = "account_id string, mob int, status string, reason string, as_of date"


@pytest.fixture(scope="module")
def hist(spark):
    d = date(2023, 5, 5)
    return spark.createDataFrame(
        [
            ("a", 3, "B", "00", d), ("a", 3, " ", "46", d), ("a", 7, "Z", "00", d),
            ("b", 24, " ", "68", d), ("b", 25, "Z", "00", d), ("b", 0, "Z", "00", d),
            ("c", 5, " ", None, d), ("c", 6, None, "57", d),
            ("d", 2, " ", "00", d), ("z", 1, "Z", "88", d), (None, 1, "Z", "88", d),
        ],
        HIST,
    )


def test_mob_events_and_pivot(spark, hist):
    accounts = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",), (None,)], "account_id string")
    events = pn.mob_events(accounts, hist, "account_id", "mob", pn.event_families())
    got = {(r[0], r.mob): (r.chargeoff, r.settlement, r.workout) for r in events.collect()}
    assert got == {
        ("a", 3): (1, 0, 1), ("a", 7): (1, 0, 0), ("b", 24): (0, 1, 0),
        ("c", 5): (0, 0, 0), ("c", 6): (0, 1, 0), ("d", 2): (0, 0, 0),
    }
    wide = {r.account_id: r for r in pn.mob_pivot(events, "account_id", "mob").collect()}
    assert set(wide) == {"a", "b", "c", "d"}
    for acct, k in product(wide, range(1, 25)):
        flags = got.get((acct, k), (0, 0, 0))
        assert tuple(wide[acct][f"{n}_mob{k}"] for n in pn.FAMILIES) == flags
    firsts = {r.account_id: tuple(r)[1:] for r in pn.first_event_mob(events, "account_id", "mob").collect()}
    assert firsts == {
        "a": (3, None, 3, 3), "b": (None, 24, None, 24), "c": (None, 6, None, 6),
        "d": (None, None, None, None),
    }
    assert tuple(wide["a"])[-4:] == firsts["a"]


def test_never_active(spark):
    rows = [("a", k, 0) for k in range(25)] + [("b", k, 0) for k in range(24)]
    rows += [("c", k, int(k == 9)) for k in range(25)] + [("a", 30, 1)]
    df = spark.createDataFrame(rows, "k string, mob int, active int")
    assert [r.k for r in pn.never_active(df, "k", "mob", "active").collect()] == ["a"]


@pytest.fixture(scope="module")
def snaps(spark):
    rows = [("a", month_end(2023, k), float(100 + k)) for k in range(0, 30) if k != 4]
    rows += [("a", date(2023, 3, 15), 9999.0), ("b", month_end(2023, 13), None)]
    rows += [("b", month_end(2023, 2), -5.0), (None, month_end(2023, 2), 1.0)]
    return spark.createDataFrame(rows, "k string, as_of date, v double")


def test_wide_panel_equals_the_self_joins(spark, snaps):
    base = spark.createDataFrame(
        [
            (1, "a", date(2023, 1, 31), 2), (2, "a", date(2023, 3, 31), 99),
            (3, "b", date(2023, 1, 31), 24), (4, "c", date(2023, 1, 31), None),
            (5, "b", None, 5), (6, None, date(2023, 1, 31), 1), (7, "a", date(2023, 1, 31), 0),
        ],
        "id int, k string, vintage date, ev int",
    )
    for hot in (None, ("a",)):
        out = pn.wide_panel(
            base, snaps, key="k", start="vintage", as_of="as_of", value="v", prefix="t",
            missing=True, event=F.col("ev"), hot=hot,
        )
        known = {(r.k, r.as_of): r.v for r in snaps.collect()}
        rows = out.collect()
        assert len(rows) == 7
        for r in rows:
            at = {
                k: known.get((r.k, month_end(r.vintage.year, r.vintage.month - 1 + k)))
                if r.vintage and r.k
                else None
                for k in range(25)
            }
            assert [r[f"t{k}"] for k in range(25)] == [at[k] or 0.0 for k in range(25)]
            assert [r[f"t{k}_missing"] for k in range(25)] == [int(at[k] is None) for k in range(25)]
            if r.ev is not None and r.ev <= 24:
                assert r.t_at_event == ((at[r.ev] or 0.0) if r.ev >= 1 else None)
            else:
                assert r.t_at_event == (at[24] or 0.0)


def test_duplicate_snapshots_raise_or_keep_the_larger(spark, snaps):
    base = spark.createDataFrame([("a", date(2023, 1, 31))], "k string, vintage date")
    twice = snaps.union(spark.createDataFrame([("a", month_end(2023, 1), 500.0)], snaps.schema))
    args = dict(key="k", start="vintage", as_of="as_of", value="v", prefix="t", hot=())
    with pytest.raises(Exception, match="more than one snapshot"):
        pn.wide_panel(base, twice, **args).collect()
    assert pn.wide_panel(base, twice, check_unique=False, **args).first()["t1"] == 500.0


def test_snapshots_are_reduced_before_they_meet_the_accounts(spark, tmp_path):
    path = str(tmp_path / "snaps")
    spark.range(10).select(
        F.col("id").cast("string").alias("k"), F.lit(date(2023, 1, 31)).alias("as_of"),
        F.lit(1.0).alias("v"), F.lit("x").alias("unused"),
    ).write.parquet(path)
    plan = pn.month_series(spark.read.parquet(path), "k", "as_of", "v")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in text
    # a partial aggregate sits below the first exchange
    assert text.rindex("Exchange") < text.rindex("partial_max")


@pytest.fixture(scope="module")
def target(spark, hist):
    pop = spark.createDataFrame(
        [("a", "2023-01"), ("b", "2023-01"), ("c", "2023-02"), ("d", "2023-02"), ("e", "2023-02")],
        "account_id string, vintage_month string",
    )
    opened = date(2022, 12, 15)
    panel = spark.createDataFrame(
        [
            ("a", 24, opened, 0), ("b", 24, opened, 95), ("b", 30, opened, 120),
            ("c", 23, opened, 100), ("d", 24, opened, 90), ("e", 24, opened, None),
        ],
        "account_id string, mob int, open_date date, dpd int",
    )
    shifts = spark.createDataFrame(
        [
            ("d", "C", "39", date(2023, 5, 1)),  # MOB 5, but 90+ DPD at 24 comes first
            ("e", "C", "36", date(2022, 11, 1)),  # MOB -1: ever, not target
            ("e", "C", "39", date(2022, 12, 1)),  # MOB 0: ever, not target
            ("a", "B", "36", date(2023, 1, 1)),  # other status
            ("c", "C", "36", date(2023, 1, 1)),  # no open date at the end
        ],
        "account_id string, status string, reason string, as_of date",
    )
    found = {}
    for source in ("end", "any"):
        lookups = account_lookups(
            pop, key="account_id", hist=hist, panel=panel, shifts=shifts, open_date_from=source
        )
        found[source] = model_target(
            base_with_flags(pop, lookups, key="account_id"), "account_id"
        )
    return found


def test_target_semantics(target):
    rows = {r.account_id: r for r in target["end"].collect()}
    assert len(rows) == 5
    assert {k: r.model_target for k, r in rows.items()} == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 0}
    assert {k: r.first_bad_mob for k, r in rows.items()} == {"a": 3, "b": 24, "c": 6, "d": 24, "e": 0}
    assert (rows["e"].ever_synthetic_first, rows["e"].ever_first_party) == (1, 1)
    assert (rows["e"].synthetic_first_mob, rows["e"].first_party_mob) == (0, -1)
    assert (rows["d"].bad_mob5, rows["d"].bad_mob24, rows["d"].dpd90_at_end) == (1, 1, 1)
    assert (rows["c"].open_date, rows["c"].first_party_mob, rows["c"].first_dpd90_mob) == (None, None, 23)
    assert rows["b"].first_dpd90_mob == 24 and rows["b"].bad_mob24 == 1
    anyhow = {r.account_id: r for r in target["any"].collect()}
    assert anyhow["c"].first_party_mob == 1 and anyhow["c"].bad_mob1 == 1


def test_target_invariants(target):
    for r in target["any"].collect():
        flags = [r[f"bad_mob{k}"] for k in range(1, 25)]
        assert r.model_target == max(flags) and r.acct_id == r.account_id
        for n in pn.FAMILIES:
            assert r[f"ever_{n}"] == int(r[f"first_{n}_mob"] is not None)


def test_waterfall(target):
    df = target["end"].withColumn("global_exclusion", F.lit(0))
    total = qc.waterfall(df).first()
    assert total.accounts == total.accounts_kept == 5 and total.total_excluded == 0
    parts = sum(total[f"{c}_wf"] for c in COMPONENTS)
    assert parts >= total.model_target and parts - total.model_target == total.component_gap == 1
    by = {r.vintage_month: r for r in qc.waterfall(df, by="vintage_month").collect()}
    assert {k: r.accounts for k, r in by.items()} == {"2023-01": 2, "2023-02": 3}
    for c in COMPONENTS:
        assert sum(r[f"{c}_wf"] for r in by.values()) == total[f"{c}_wf"]


def test_two_end_snapshots_raise(spark):
    from vintage_panel.operators.target import snapshot_lookup

    d = date(2023, 1, 1)
    panel = spark.createDataFrame(
        [("a", 24, d, 0), ("a", 24, d, 1)], "k string, mob int, open_date date, dpd int"
    )
    with pytest.raises(Exception, match="more than one MOB-24 snapshot"):
        snapshot_lookup(panel, "k").collect()


def test_reconcile_null_counts_as_match(spark):
    ours = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, 9.0), ("b", 1, 5.0), ("c", 1, 5.0)], "k string, t int, v double"
    )
    other = spark.createDataFrame(
        [("a", 1, 5.0), ("b", 2, 5.0), ("b", 1, 6.0)], "k string, p int, w double"
    )
    got = qc.reconcile(ours, other, key="k", value="v", other_value="w", other_order="p", tie=("t",))
    assert {r.ind: r.accounts for r in got.collect()} == {"Match": 2, "NO match": 1}
