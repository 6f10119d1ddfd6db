import re
from collections import Counter

from vintage_panel.llm.quality import quality, statistics, thresholds

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def test_statistics_equal_brute_force(table, edge_rows):
    rows = [
        *edge_rows,
        (50, "a b c d e f g h i " * 3, "en", "a"),
        (51, "a " * 40, "en", "a"),
        (52, "a b c d e f g h", "en", "a"),
        (53, "# x\n# x\n\n\n# x\ny", "en", "a"),
    ]
    got = statistics(table(rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[n] for n in names) for r in got] == [brute(r[1]) for r in rows]


def test_verdicts(table, edge_rows):
    clean = [(i, " ".join(f"w{i * 31 + k}" for k in range(40)), "en", "s") for i in range(60)]
    odd = [(1000, " ".join(f"w{k}###" for k in range(40)), "en", "s"), (1001, "too short", "en", "s"),
           (1002, "a b c d e f g h i j " * 9, "en", "s")]
    got = {r["doc_id"]: r for r in quality(table(clean + odd)).collect()}
    assert all(got[i]["kept"] for i in range(60))
    assert (got[1000]["kept"], got[1000]["rule"]) == (False, "symbols")
    assert got[1001]["base_failed"] and got[1002]["base_failed"] and not got[1002]["kept"]
    assert len(quality(table(edge_rows)).collect()) == len(edge_rows)


def test_thresholds_follow_language_and_source(spark):
    rows = [(lang, "s", "symbols", v, 10) for lang, top in (("en", 5), ("code", 400)) for v in range(0, top + 1)]
    got = {r["lang"]: r["edge_symbols"] for r in thresholds(
        spark.createDataFrame(rows, "lang string, source string, metric string, value long, n long")).collect()}
    assert got["en"] < 100 < 400 < got["code"]


def test_a_small_group_does_not_set_its_own_limit(table):
    clean = [(i, " ".join(f"w{i * 31 + k}" for k in range(40)), "en", "s") for i in range(60)]
    junk = lambda i: " ".join(f"w{i}{k}###" for k in range(40))
    alone = [(1000 + i, junk(i), "en", f"alone{i}") for i in range(3)]  # a source each
    tongue = [(1100 + i, junk(i), f"lang{i}", "s") for i in range(3)]  # a language each
    together = [(1200 + i, junk(i), None, None) for i in range(3)]  # three in one group
    good = [(1300 + i, " ".join(f"v{i}{k}" for k in range(40)), f"tongue{i}", "t") for i in range(3)]
    got = {r["doc_id"]: r for r in quality(table(clean + alone + tongue + together + good)).collect()}
    assert all(got[r[0]]["kept"] for r in clean + good)
    assert {got[r[0]]["rule"] for r in alone + tongue + together} == {"symbols"}
    few = quality(table(alone)).collect()  # no other rows to lean on
    assert [r["rule"] for r in few] == ["symbols"] * 3


def test_a_large_group_keeps_its_own_limit(spark):
    rows = [("en", "prose", "symbols", v, 100) for v in range(20)] + [("en", "code", "symbols", v, 4) for v in range(200, 300)]
    got = {r["source"]: r["edge_symbols"] for r in thresholds(
        spark.createDataFrame(rows, "lang string, source string, metric string, value long, n long")).collect()}
    assert got["prose"] <= 80 and got["code"] > 400


def test_empty(empty):
    assert quality(empty).collect() == []
