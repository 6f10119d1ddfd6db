import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vintage_panel.llm.queries import ORACLES, QUERIES

ROOT = Path("/root/testdata/sf0.001")


def test_stages_keep_the_columns(spark, table, edge_rows, tmp_path):
    docs = table(edge_rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert df.columns == columns
        df.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0
    assert docs.filter(~F.col("round_trip")).count() == 0


def test_many_near_languages_lose_no_document(table):
    rng = random.Random(7)
    stem = lambda: "".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(3))
    shared = [stem() for _ in range(200)]
    rows = []
    for k in range(12):  # nineteen of twenty words are common to all
        own = [stem() for _ in range(20)]
        rows += [(100 * k + i, " ".join(rng.choice(own if j % 20 == 0 else shared) for j in range(60)), f"l{k}", "a")
                 for i in range(10)]
    foreign = [(5000, "Ελληνικό κείμενο σε άλλη γραφή", None, "a"), (5001, "xqzw vfxq wzxj qqvx", None, "a")]
    kept = corpus_pipeline.identify_language(None, table(rows + foreign), "")
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [r[0] for r in rows]


def test_stages_take_an_empty_table(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []


@pytest.mark.skipif(not ROOT.exists(), reason="supplied tables not present")
def test_run(spark):
    rows = corpus_pipeline.run(spark, str(ROOT)).collect()
    assert rows and all(r["round_trip"] and len(r["ids"]) == r["n_ids"] for r in rows)


def test_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(ORACLES) <= set(QUERIES)
