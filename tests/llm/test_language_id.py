import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vintage_panel.llm import language_id as module
from vintage_panel.llm.language_id import GRAMS, Model, Scorer, fit, language_id, train_counts, words_of
from vintage_panel.llm.queries import op9_language_id

ROOT = Path("/root/testdata/sf0.01")


def counts_of(rows):
    """What the model is made of, in plain Python: size -> piece -> language -> count."""
    out = {}
    for text, lang in sorted({r for r in rows if None not in r}):
        for word in words_of(text):
            framed = f"_{word}_"
            pieces = [(0, word), *((s, framed[i : i + s]) for s in GRAMS for i in range(len(framed) - s + 1))]
            for size, piece in pieces:
                seen = out.setdefault(size, {}).setdefault(piece, {})
                seen[lang] = seen.get(lang, 0) + 1
    kept = {s: {p: {x: n for x, n in seen.items() if n >= 2} for p, seen in ps.items()} for s, ps in out.items()}
    total = {(s, x): sum(seen.get(x, 0) for seen in ps.values()) for s, ps in kept.items() for x in {y for z in ps.values() for y in z}}
    kept = {s: {p: {x: n for x, n in seen.items() if n * module.PIECES >= total[s, x]} for p, seen in ps.items()}
            for s, ps in kept.items()}
    return {s: {p: seen for p, seen in ps.items() if seen} for s, ps in kept.items()}


def brute(counts, text):
    """Language, score and share of known words, one piece at a time."""
    langs = sorted({x for ps in counts.values() for seen in ps.values() for x in seen})
    words = words_of(text)
    if not words or not langs:
        return "und", 0.0, 0.0
    total = {s: {x: sum(seen.get(x, 0) for seen in ps.values()) for x in langs} for s, ps in counts.items()}

    def log(size, piece, x):
        return math.log((counts[size][piece].get(x, 0) + 0.5) / (total[size][x] + 0.5 * len(counts[size])))

    def pieces(word):
        if word in counts.get(0, {}):
            return [(0, word)]
        out, framed = [], f"_{word}_"
        todo = [framed[i : i + 5] for i in range(len(framed) - 4)] or [framed]
        todo = [(i, g) for i, g in enumerate(todo)]
        while todo:
            out += [(len(g), g) for _, g in todo if g in counts.get(len(g), {})]
            below = {}
            for i, g in todo:
                if g not in counts.get(len(g), {}) and len(g) > 1:
                    below |= {i: g[:-1], i + 1: g[1:]}
            todo = sorted(below.items())
        return out

    sums, n = dict.fromkeys(langs, 0.0), 0
    for word in words:
        found = pieces(word)
        n += bool(found)
        for x in langs:
            sums[x] += sum(log(s, p, x) for s, p in found) / max(1, len(found))
    best = max(langs, key=lambda x: (round(sums[x], 6), [-ord(c) for c in x]))
    known = 0.0
    for word in words:
        grams = [f"_{word}_"[i : i + 3] for i in range(len(word))]
        whole = best in counts.get(0, {}).get(word, {})
        known += 1 if whole else sum(best in counts.get(3, {}).get(g, {}) for g in grams) / len(grams)
    score = 1 / sum(math.exp((sums[x] - sums[best]) / max(n, 1)) for x in langs)
    return best, score, known / len(words)


def test_backoff_uses_the_longest_known_grams():
    model = Model.of_counts({
        0: {"known": {"x": 9, "y": 4}},
        5: {"_abcd": {"x": 3}},
        4: {"bcde": {"x": 2, "y": 2}},
        2: {"e_": {"y": 5}},
    })
    scores, seen = model.scores(["known", "abcde", "zzz"])
    log = math.log
    assert scores[0] == pytest.approx([log(9.5 / 9.5), log(4.5 / 4.5)], abs=1e-6)
    # _abcde_: _abcd known; abcde -> abcd, bcde; bcde_ -> bcde, cde_; cde_ -> ... -> e_
    x = log(3.5 / 3.5) + log(2.5 / 2.5) + log(0.5 / 0.5)
    y = log(0.5 / 0.5) + log(2.5 / 2.5) + log(5.5 / 5.5)
    assert scores[1] == pytest.approx([x / 3, y / 3], abs=1e-6)
    assert seen.tolist() == [True, True, False]


def test_equals_brute_force(spark, table, edge_rows):
    rng = random.Random(5)
    alphabet = {"en": "abcdeo", "fr": "aeioué", "xx": "bcdkéz"}
    rows = [
        (3000 + i, " ".join("".join(rng.choice(cs) for _ in range(rng.randint(1, 7))) for _ in range(30)), lang, "a")
        for i in range(25) for lang, cs in alphabet.items()
    ]
    docs = table(rows + edge_rows)
    counts = counts_of([(r[1], r[2]) for r in rows + edge_rows])
    found = language_id(docs, fit(docs), known=True).collect()
    assert len(found) == len(rows + edge_rows)
    for r in found:
        lang, score, known = brute(counts, r["row"]["text"])
        assert (r["lang_pred"], r["score"], r["known"]) == (lang, pytest.approx(score, abs=1e-4), pytest.approx(known, abs=1e-4))


def test_long_texts_are_scored_in_parts(monkeypatch):
    model = Model.of_counts({0: {"a": {"x": 9}, "b": {"y": 9}}, 3: {"_c_": {"x": 2, "y": 3}}})
    text = "a b b c d " * 700
    texts = [text, "a", None, "b c", text]
    whole = list(Scorer(model, True)(texts))
    monkeypatch.setattr(module, "KEPT_CELLS", 0)
    monkeypatch.setattr(module, "TOGETHER", 2)
    for a, b in zip(Scorer(model, True)(texts), whole, strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:])


def test_500_languages(spark):
    rng = random.Random(11)
    stem = lambda: "".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(4))
    rows = []
    for k in range(500):  # one label holds a third of all rows, the last ones three rows each
        own = [stem() for _ in range(12)]
        rows += [(f"{' '.join(own)} {rng.choice(own)}", f"l{k:03}") for _ in range(750 if k == 0 else 3)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = fit(docs)
    assert len(model.langs) == 500
    assert sum(len(t.langs) for t in model.tables.values()) <= module.ENTRIES
    got = language_id(docs, model).filter("lang_pred = row.lang").count()
    assert got >= 0.999 * len(rows)


def test_rare_languages_keep_their_words_under_a_small_bound(spark, monkeypatch):
    rows = [(f"common{i % 400} word{i % 300}", "big") for i in range(3000)] + [("rara avis nostra", "small")] * 3 + [
        ("rara avis mea", "small"), ("nostra avis mea", "small")]
    monkeypatch.setattr(module, "ENTRIES", 1200)
    model = fit(spark.createDataFrame(rows, "text string, lang string"))
    assert sum(len(t.langs) for t in model.tables.values()) <= 1200
    assert (model.tables[0].places(["rara", "avis", "nostra", "mea"]) >= 0).all()


def test_edges(table, edge_rows, empty):
    docs = table([*edge_rows, (900, "123 !!", "en", "a")])
    model = fit(docs)
    got = language_id(docs, model).select("row.text", "lang_pred", "score").collect()
    assert len(got) == len(edge_rows) + 1
    for text, lang, score in got:
        if text is None or not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
        else:
            assert lang in ("en", "fr") and 0 < score <= 1
    untaught = fit(empty)
    assert list(Scorer(untaught)(["some words"])) == [("und", 0.0, 0.0)]
    assert language_id(empty, untaught).collect() == []


@pytest.mark.skipif(not ROOT.exists(), reason="supplied tables not present")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "lang")
    got = op9_language_id(spark, str(ROOT)).join(truth, "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98


HINDI = "यह नदी के किनारे बसा हुआ एक पुराना शहर है और यहाँ के लोग खेती करते हैं पहाड़ों में बर्फ़ गिरती है".split()
MARATHI = "ही नदीच्या काठी वसलेली जुनी वस्ती आहे आणि इथले लोक शेती करतात डोंगरांत पाऊस पडतो तेव्हा फुले येतात".split()


def test_scripts_with_combining_marks(spark):
    rng = random.Random(2)
    rows = [
        (2 * i + k, " ".join(rng.choice(words) for _ in range(40)), lang)
        for i in range(100) for k, (lang, words) in enumerate((("hi", HINDI), ("mr", MARATHI)))
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(docs)
    assert (model.tables[0].places(HINDI + MARATHI) >= 0).all()  # whole words, not pieces between marks
    found = language_id(docs, model, known=True).collect()
    assert all(r["lang_pred"] == r["row"]["lang"] and r["known"] == 1 for r in found)
    odd = spark.createDataFrame([(1, "½ ²"), (2, "́ 12 _"), (3, "Ⅷ")], "doc_id long, text string")
    assert {r["lang_pred"] for r in language_id(odd, model).collect()} == {"und"}


def test_texts_are_not_dealt_by_language(spark):
    docs = spark.createDataFrame([(f"the land {i}", "en") for i in range(9)], "text string, lang string")
    plan = train_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_filter_does_not_score_twice(spark):
    docs = spark.createDataFrame([(1, "the land", "en")], "doc_id long, text string, lang string")
    kept = language_id(docs, fit(docs), known=True).filter("lang_pred <> 'und' and known >= 0.5").select("row.text", "lang_pred")
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
