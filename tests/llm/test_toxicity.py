import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vintage_panel.llm import deobfuscate as de, toxicity as tox

from conftest import prose as with_numbers

BAD = ("vermin", "rotten", "wretch", "horrid", "filthy", "bandit")
LOOK = str.maketrans({"i": "1", "o": "0", "e": "3", "t": "7"})


def prose(rng, n):
    return re.sub("[0-9]+", "", with_numbers(rng, n))


def disguised(word, way):
    if way == 0:
        return word.translate(LOOK)
    if way == 1:
        return " ".join(word)
    if way == 2:
        return word[0] + word[1] * 4 + word[2:]
    return ".".join(word).upper()


def toxic_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = prose(rng, rng.randint(15, 60)).split()
        bad = i % 3 == 0
        for _ in range(2 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        out.append((i, " ".join(words), "en", "a", int(bad)))
    return out


def cells_of(text):
    s = de.symbols(f"   {text.lower()}   ").tolist()
    return Counter(((s[i] * 28 + s[i + 1]) * 28 + s[i + 2]) * 28 + s[i + 3] for i in range(len(s) - 3))


def test_counts_equal_plain_counts(monkeypatch):
    monkeypatch.setattr(de, "CHARS", 50)
    rng = random.Random(1)
    texts = ["", None, "a", "Ab 1é", "x" * 50, "y" * 51] + [prose(rng, rng.randint(0, 60)) for _ in range(30)]
    batches = [pa.record_batch([pa.array(texts[a : a + 7])], names=["t"]) for a in range(0, len(texts), 7)]
    (out,) = de._counted(iter(batches))
    expected = sum((cells_of(t or "") for t in texts), Counter())
    assert dict(zip(out.column("cell").to_pylist(), out.column("n").to_pylist())) == dict(expected)


def test_model_is_a_distribution():
    seen = np.zeros(28**4)
    for cell, n in cells_of("the rotten bandit and the vermin").items():
        seen[cell] = n
    likely = np.exp(-de.costs(seen)).reshape(-1, 28)
    assert np.allclose(likely.sum(axis=1), 1, atol=1e-4)


def test_reading_equals_all_readings():
    rng = random.Random(4)
    seen = np.zeros(28**4)
    for cell, n in sum((cells_of(t) for _, t, *_ in toxic_rows(200, 2)), Counter()).items():
        seen[cell] = n
    restorer = de.Restorer(de.costs(seen))

    def cost(path):
        total, at = 0.0, 0
        for s in path:
            total += float(restorer.model[at * 28 + s])
            at = (at * 28 + s) % 28**3
        return total

    for _ in range(60):
        text = "".join(rng.choice("ab1t0e3$.l!") for _ in range(rng.randint(1, 7)))
        ways = list(restorer._edges(text))
        best = min(
            sum(c for _, c in choice) + cost([*de.symbols("".join(x for x, _ in choice)).tolist(), 0])
            for choice in itertools.product(*ways)
        )
        got = restorer._viterbi(text)
        mine = min(
            sum(c for _, c in choice) + cost([*de.symbols(got).tolist(), 0])
            for choice in itertools.product(*ways) if "".join(x for x, _ in choice) == got
        )
        assert math.isclose(best, mine, rel_tol=1e-5)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(toxic_rows(600, 11), "doc_id long, text string, lang string, source string, toxic int")


@pytest.fixture(scope="module")
def model(corpus):
    return tox.fit(corpus, de.language_model(corpus))


def test_disguised_words_are_found(spark, model, corpus):
    restore = de.Restorer(model.costs)
    for word in BAD:
        for way in range(4):
            assert word in restore(f"the land {disguised(word, way)}, and stones").replace(",", " ").split()
    rng = random.Random(3)
    rows = []
    for i in range(120):
        words = prose(rng, 80).split()
        if i % 2:
            words.insert(rng.randrange(80), disguised(rng.choice(BAD), i // 2 % 4))
        rows.append((i, " ".join(words)))
    scored = tox.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), model)
    for r in scored.collect():
        assert r["predicted"] == r["row"]["doc_id"] % 2, r


def test_clean_text_stays(model):
    restore = de.Restorer(model.costs)
    for text in ("Plain words, here; and there...", "", "a b", "in 1999 and 2005", "x yy x", "Straße éà"):
        assert restore(text) == text.lower()


def test_held_out_accuracy(corpus, model):
    fresh = corpus.sparkSession.createDataFrame(toxic_rows(300, 99), corpus.schema)
    scored = tox.toxicity(fresh, model).collect()
    assert np.mean([r["predicted"] == r["row"]["toxic"] for r in scored]) > 0.98
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.5) == bool(r["predicted"]) for r in scored)


def test_edges(spark, table, empty, edge_rows, model):
    rows = edge_rows + [(500, "i " * 4000, None, None), (501, "x1" * 3000, None, None), (502, "*" * 300 + "a*b", None, None)]
    docs = table(rows)
    scored = tox.toxicity(docs, model).collect()
    assert len(scored) == len(rows)
    plain = 1 / (1 + math.exp(-model.intercept))
    for r in scored:
        if not (r["row"]["text"] or "").strip():
            assert math.isclose(r["score"], plain)
    labels = spark.createDataFrame([(4, 1), (None, 1), (5, 0), (5, 1), (7, None)], "doc_id long, toxic int")
    got = tox.score_documents(docs, labels, F.lit(False)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert tox.score_documents(empty, labels).collect() == []


def test_long_text_is_read_whole(model, monkeypatch):
    restore = de.Restorer(model.costs)
    text = "the land of v3rmin and r0tten stones " * 200
    whole = restore(text)
    monkeypatch.setattr(de, "CHARS", 100)
    assert restore(text) == whole and whole.count("vermin") == whole.count("rotten") == 200


def test_no_labels(spark, corpus):
    costs = np.zeros(28**4, np.float32)
    none = spark.createDataFrame([], "text string, toxic int")
    assert tox.fit(none, costs).weights == {}
    one = corpus.filter("toxic = 0")
    scored = tox.toxicity(one.limit(3), tox.fit(one, costs)).collect()
    assert all(r["predicted"] == 0 and r["score"] < 1e-9 for r in scored)


def test_only_texts_of_the_sample_meet_their_labels(spark, monkeypatch):
    """The sample of the plain join, ids and texts repeated and NULL, without moving a text."""
    monkeypatch.setattr(tox, "SAMPLE", 20)
    rows = [(i % 90 if i % 7 else None, f"text {i % 60}" if i % 11 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2 if i % 9 else None) for i in range(80)], "doc_id long, toxic int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        drawn = tox.drawn(docs, marks)
        assert "Exchange hashpartitioning" not in drawn._jdf.queryExecution().executedPlan().toString()
        got = Counter(tuple(r) for r in drawn.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    label = (F.col("toxic") == 1).cast("int").alias("label")
    plain = docs.join(marks, "doc_id").filter("text is not null and toxic is not null").select("text", label)
    chosen = tox._chosen(plain.withColumn("draw", tox._draw(F.col("text"))))
    assert got == Counter(tuple(r) for r in chosen.select("text", "label").collect())
    assert 0 < sum(got.values()) < plain.count()
