import pytest
from pyspark.sql import functions as F

from vintage_panel.llm import mixing
from vintage_panel.llm.common import words as words_of


def targets(sizes, weights=(3, 1, 2)):
    """Water filling by bisection on the level."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, low, high = 1.5 * sum(sizes.values()), 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2 * sizes[s], w[s] * mid) for s in names) < total else (low, mid)
    return {s: min(2 * sizes[s], w[s] * high) for s in names}


def test_targets_and_taken(table):
    rows = [(i, "word " * (1 + i * 7 % 30), None, [None, "a", "b", "ß", "Z"][i * i % 5]) for i in range(800)]
    got = mixing.mixed_sizes(table(rows)).collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    want = targets(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["source_size"] == sizes[s]
        assert mine[0]["target"] == pytest.approx(want[s], rel=1e-9)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= 60
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in mine)


def test_mix_repeats_rows_by_their_plan(table, edge_rows):
    docs = table(edge_rows)
    plan = mixing.mixed_sizes(docs).groupBy("doc_id").agg(F.sum("taken").alias("taken")).collect()
    mixed = mixing.mix(docs).select("row.*")
    assert mixed.columns == docs.columns
    words = mixed.select(F.col("doc_id"), F.size(words_of(F.col("text"))).alias("taken")).groupBy("doc_id").agg(F.sum("taken").alias("taken"))
    assert {r["doc_id"]: r["taken"] for r in words.collect() if r["taken"]} == {r["doc_id"]: r["taken"] for r in plan if r["taken"]}
    again = mixing.mix(docs).select("row.doc_id", "shard", "copy")
    assert sorted(map(str, again.collect())) == sorted(map(str, mixing.mix(docs).select("row.doc_id", "shard", "copy").collect()))


def test_quotas_split_exactly_and_evenly(spark):
    quotas = spark.createDataFrame([("a", 1000), ("b", 37), ("c", 0), ("d", 463)], "source string, quota long")
    parts = mixing.split_quotas(quotas, 4).collect()
    by_shard, by_source = {}, {}
    for r in parts:
        n = r["upto"] - r["first"]
        assert n >= 0
        by_shard[r["shard"]] = by_shard.get(r["shard"], 0) + n
        by_source.setdefault(r["source"], []).append((r["first"], r["upto"]))
    assert sorted(by_shard) == list(range(16)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    for name, quota in (("a", 1000), ("b", 37), ("c", 0), ("d", 463)):
        cuts = sorted(x for x in by_source[name] if x[0] < x[1])
        assert [a for a, _ in cuts] == [0, *[b for _, b in cuts]][: len(cuts)]
        assert (cuts[-1][1] if cuts else 0) == quota


def test_draws_follow_the_hypergeometric_distribution(spark):
    """Mean and variance of the draw over many chances."""
    draw = mixing._draw("40L", "15L", "18L", "u")
    df = spark.range(2000).select(((F.col("id") + 0.5) / 2000).alias("u")).select(F.expr(draw).alias("x"))
    mean, var = df.agg(F.avg("x"), F.var_pop("x")).first()
    assert mean == pytest.approx(18 * 15 / 40, abs=0.02)
    assert var == pytest.approx(18 * 15 / 40 * 25 / 40 * 22 / 39, rel=0.03)


def test_edges(table, empty):
    assert mixing.mixed_sizes(empty).collect() == []
    assert mixing.mix(empty).collect() == []
    nothing = mixing.mixed_sizes(table([(1, None, None, None), (2, "", None, "a")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2
