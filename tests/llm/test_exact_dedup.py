import hashlib
from collections import defaultdict

from vintage_panel.llm.exact_dedup import exact_dedup

A_Z = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(A_Z)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        stays = ids.index(keep)
        out += [(i, keep, len(ids), k == stays, sha) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def test_groups_equal_brute_force(table, edge_rows):
    for parts in (1, 3, 40):  # many partitions cut groups at their ends
        got = exact_dedup(table(edge_rows), n_partitions=parts)
        assert sorted(map(tuple, got.collect()), key=str) == brute(edge_rows)


def test_hot_group_over_many_partitions(table):
    rows = [(i, "Same Text" if i % 3 else f"text {i}", None, None) for i in range(600)]
    got = exact_dedup(table(rows), n_partitions=25)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_empty(empty):
    assert exact_dedup(empty).collect() == []
