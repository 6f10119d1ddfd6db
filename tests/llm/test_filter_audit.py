import re
from collections import defaultdict
from itertools import combinations, permutations

import numpy as np
import pytest
from hypothesis import given, strategies as st

from vintage_panel.llm import filter_audit as fa

LABELS = "doc_id long, quality int, toxic int, part string, text string"


def failing(rows):
    out = []
    for i, t, lang, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append(
            [
                len(w) < 200, 100 * len(set(w)) < 50 * len(w),
                100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)),
                any(j is not None and i is not None and j < i and (u or "") == t for j, u, *_ in rows),
            ]
        )
    return out


def brute(rows, labels):
    marks = defaultdict(lambda: [0, 0])
    for i, quality, toxic, *_ in labels:
        if i is not None:
            marks[i][0] |= quality == 1
            marks[i][1] |= toxic == 1
    parts = defaultdict(list)
    for r, f in zip(rows, failing(rows), strict=True):
        parts[r[2] or ""].append((f, *(marks[r[0]] if r[0] is not None else [0, 0])))
    out = {}
    for part, docs in parts.items():
        shapley = defaultdict(int)
        for order in permutations(range(5)):
            alive = docs
            for step, k in enumerate(order, 1):
                here = [d for d in alive if d[0][k]]
                alive = [d for d in alive if not d[0][k]]
                shapley[k] += len(here)
                fails = sum(d[0][k] for d in docs)
                out[part, "".join("ABCDE"[x] for x in order), step] = [
                    len(alive), len(here), fails - len(here), sum(d[0][k] and sum(d[0]) == 1 for d in docs),
                    sum(int(d[1]) for d in here), sum(int(d[2]) for d in here), k,
                ]
        for (p, _, _), row in out.items():
            if p == part:
                row[6] = shapley[row[6]]
    return out


def found(df):
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    assert len({(r["part"], r["filter_order"], r["step"]) for r in rows}) == len(rows)
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in columns] for r in rows}


LABELLED = [(1, 1, 0), (2, 0, 1), (4, 1, None), (4, None, 1), (5, 1, 1), (7, 1, 0), (None, 1, 1), (8, 1, 1), (8, 1, 1), (999, 1, 1)]


def test_orders_equal_brute_force(spark, table, edge_rows):
    rows = edge_rows + [(300, "same # text", "en", "a"), (301, "same # text", "fr", "a"), (302, "A B C", "", "a"), (303, "A B C", None, "a")]
    labels = spark.createDataFrame([(*x, "p", "t") for x in LABELLED], LABELS)
    assert found(fa.filter_audit(table(rows), labels)) == brute(rows, LABELLED)


@pytest.mark.parametrize("size, n", [(1, 1), (7, 3), (50, 40)])
def test_ranges_of_any_size_sum_up_alike(spark, table, size, n):
    texts = ["x $", "A b", "z " * 300, "w", " ".join(map(str, range(250)))]
    rows = [(i % 60 if i % 50 else None, texts[i * i % 5], "en" if i % 3 else "de", None) for i in range(200)]
    flags = fa.failed_filters(table(rows)).selectExpr("*", "0 as good")
    lists = fa.posting_lists(flags, marks=["good"], size=size, n_partitions=n)
    for r in lists.collect():
        assert 0 < r["n"] <= size and len(r["lists"]) == 6
        assert all(x == sorted(set(x)) and all(0 <= v < r["n"] for v in x) for x in r["lists"])
    got = fa.audit_orders(fa.interactions(lists, n_marks=1)).withColumnsRenamed({"marked_0": "good_lost"})
    got = got.selectExpr("*", "0L as toxic_lost")
    assert found(got) == brute(rows, [])


def test_no_documents(spark, empty):
    labels = spark.createDataFrame([], LABELS)
    assert fa.filter_audit(empty, labels).collect() == []


ids = st.lists(st.integers(0, 60), unique=True).map(lambda x: np.array(sorted(x), np.int32))


@given(st.lists(ids, min_size=3, max_size=4))
def test_merges_equal_sets(lists):
    sets = [set(x.tolist()) for x in lists]
    for (k, others), left in fa.left_over(lists).items():
        gone = set().union(*(s for j, s in enumerate(sets) if others >> j & 1))
        assert left.tolist() == sorted(sets[k] - gone)
    for a, b in combinations(range(len(lists)), 2):
        assert fa.common(lists[a], lists[b]) == len(sets[a] & sets[b])
