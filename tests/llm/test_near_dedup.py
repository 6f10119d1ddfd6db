import random
import string
from itertools import combinations

import numpy as np
import pytest

from vintage_panel.llm.components import connected_components
from vintage_panel.llm.near_dedup import _permutations, min_max, near_dedup, near_groups
from vintage_panel.llm.shingles import Shingler

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    words = (text or "").translate(FOLD).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids, default=None) if sets[i] else r[0]))
    return sorted(out, key=str)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


def chains(rng):
    """Near copies, near copies of near copies, and documents that share half of their words."""
    rows = []
    for family in range(6):
        words = [f"w{family}x{rng.randint(0, 400)}" for _ in range(120)]
        for _ in range(8):
            rows.append(" ".join(words))
            words = edited(rng, words, rng.randint(0, 5)).split()
        rows += [edited(rng, words, 12) for _ in range(4)]
        rows.append(" ".join(words[:60] + [f"other{family}{i}" for i in range(60)]))
    return [(i, t, "en", "a") for i, t in enumerate(rows)]


def test_components_equal_brute_force(table, edge_rows):
    rows = [(1000 + i, *r) for i, *r in chains(random.Random(1))] + edge_rows
    got = near_groups(table(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_one_of_each_group_stays(table, edge_rows):
    rows = [(1000 + i, *r) for i, *r in chains(random.Random(2))] + edge_rows
    docs = table(rows)
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    sets = [shingles(r[1]) for r in rows]
    numbered = [(i, *r[1:]) for i, r in enumerate(rows)]  # ids that tell components apart
    components = {c for _, n, c in brute(numbered) if n}
    assert kept.count() == len(components) + sum(not s for s in sets)


def test_signature_estimates_similarity():
    rng = random.Random(5)
    one = [f"a{rng.randint(0, 10**6)}" for _ in range(3000)]
    two = one[:2400] + [f"b{rng.randint(0, 10**6)}" for _ in range(600)]
    odd, add = _permutations(2000)
    s = Shingler()
    a, b = s(" ".join(one)), s(" ".join(two))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert np.mean(min_max(a, odd, add) == min_max(b, odd, add)) == pytest.approx(true, abs=0.03)


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {x: x for e in edges for x in e}
    for _ in range(500):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, connected_components(df).collect()))
    assert got == {x: r for x, r in root.items() if x != r}


def test_empty(empty):
    assert near_groups(empty).collect() == []
    assert near_dedup(empty).collect() == []
