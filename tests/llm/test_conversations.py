import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vintage_panel.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(ops):
    """Least (cost, audit) over all edits, by looking at every state with every audit."""

    @lru_cache(None)
    def to_go(i, q, inserts):
        found = []
        if i == len(ops) and q in "0a":
            found.append((0, ""))
        after = "a" if q == "u" else "u"
        if inserts < 3:  # more in a row are never cheapest
            c, a = to_go(i, after, inserts + 1)
            found.append((c + 5, "I" + a))
        if i < len(ops):
            ini, fault = ops[i]
            c, a = to_go(i + 1, q, 0)
            found.append((c + 2, "D" + a))
            if fault < 2:
                c, a = to_go(i + 1, after, 0)
                found.append((c + 1 + 5 * fault, "R" + a))
                if ini == after or (ini == "s" and q == "0"):
                    c, a = to_go(i + 1, ini, 0)
                    found.append((c + 5 * fault, "K" + a))
        return min(found) if found else (10**9, "")

    return to_go(0, "0", 0)


def brute(rows, ids):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv in ids:
        own = sorted(convs[conv], key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        ops, sums, seen = [], dict.fromkeys(["blank", "duplicate", "truncated", "illegal"], 0), set()
        for k, (_, _, role, text) in enumerate(own):
            bare = text.strip(cv.SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                sums[fault] += 1
            ops.append((role[:1], {None: 0, "truncated": 1}.get(fault, 2)))
            sums["illegal"] += k > 0 and own[k - 1][2][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit = cheapest(ops)
        lines, at, q = [], iter(zip(own, ops)), "0"
        for letter in audit:
            (_, _, role, text), (ini, _) = next(at) if letter != "I" else ((0, 0, "", ""), ("", 0))
            if letter == "D":
                continue
            q = ini if letter == "K" else "a" if q == "u" else "u"
            name = role if letter == "K" else {"u": "user", "a": "assistant"}[q]
            lines.append((q, f"{name}:{text}"))
        assert GRAMMAR.fullmatch("".join(x[0] for x in lines))
        turns = {r[1] for r in own if r[0]}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        sha = hashlib.sha256("\n".join(x[1] for x in lines).encode()).hexdigest()
        out[conv] = (gaps, *sums.values(), cost, audit, sha)
    return out


def found(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def odd_rows():
    rng = random.Random(5)
    texts = ["Yes.", "No?", "and then", "", " \t\n", "Ja! \x0b", "x. y", None, "é€.", "a" * 3000]
    roles = ["user", "assistant", "system", "u", "tool", "", None, "User"]
    rows = [
        (rng.choice([None, *range(1, 60)]), rng.choice([None, 0, 1, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts))
        for _ in range(330)
    ]
    return rows + rows[:40] + [(70, None, None, None), (71, 2**40, "user", "Hi."), (71, 0, "assistant", "Hi.")]


def build(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(f"other {c}") for c in ("kind", "audit", "first", "said", "c", "times", "answer")})


def test_repair_equals_brute_force(spark):
    rows = odd_rows()
    assert found(cv.repair(build(spark, rows))) == brute(rows, {r[0] for r in rows})


def test_damage(spark):
    rows = odd_rows()
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        dealt, text, role = zlib.crc32(key.encode()) % 20, " " if text is None else text, " " if role is None else role
        if dealt:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(dealt, text)
            out += [(conv, turn, "user" if dealt == 4 else role, text)] * (1 + (dealt == 3))
    damaged = cv.damage(build(spark, rows))
    assert sorted(map(tuple, damaged.collect()), key=str) == sorted(out, key=str)
    # conversations that lost all their rows are reported too
    ids = {r[0] for r in rows} | {900, 901}
    named = spark.createDataFrame([(i,) for i in ids for _ in range(2)], "conv_id long")
    assert found(cv.repair(damaged, named)) == brute(out, ids)


def test_long_conversation_and_hot_text(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Same.", f"t{t}.", f"t{t}", ""])) for t in range(6000)]
    rows += [(2, 1, "user", "Copy.")] * 3000 + [(c, 0, "user", "Same.") for c in range(3, 40)]
    got = found(cv.repair(build(spark, rows)))
    own = sorted((t, r, x) for c, t, r, x in rows if c == 1)
    seen, codes = set(), bytearray()
    for _, role, text in own:
        fault = 2 if not text or (role, text) in seen else 0 if text[-1] == "." else 1
        seen.add((role, text))
        codes.append(3 * ("sua".find(role[0]) + 1) + fault)
    assert got[1][5:7] == forward_only(bytes(codes))
    assert got[2] == (0, 0, 2999, 0, 2999, 6000, "D" * 3000, hashlib.sha256(b"").hexdigest())


def forward_only(codes):
    """The plain recurrence over rows, keeping the least (cost, audit) of each state."""
    best = {0: (0, "")}

    def closed(best):
        for _ in range(2):
            for q, (c, a) in list(best.items()):
                to = cv._after(q)
                best[to] = min(best.get(to, (10**9, "")), (c + 5, a + "I"))
        return best

    best = closed(best)
    for code in codes:
        new = {}
        for q, (c, a) in best.items():
            for letter, cost, to in cv.AHEAD[code][q]:
                new[to] = min(new.get(to, (10**9, "")), (c + cost, a + letter))
        best = closed(new)
    return min(best[q] for q in (0, 3) if q in best)


def test_empty(spark):
    assert cv.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    assert cv.damage(spark.createDataFrame([], SCHEMA)).collect() == []


rows_of = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x"]), st.integers(0, 2)), max_size=9)


@settings(max_examples=600, deadline=None)
@given(rows_of)
def test_cheapest_edits_equal_all_edits(ops):
    codes = bytes(3 * ("sua".find(i) + 1) + f for i, f in ops)
    assert cv.cheapest_edits(codes) == cheapest(tuple(ops))


@pytest.mark.parametrize(
    "codes, answer",
    [(b"", (0, "")), (b"\x03", (2, "D")), (b"\x03\x03", (2, "RR")), (b"\x06\x09", (0, "KK")), (b"\x08\x08", (4, "DD"))],
)
def test_few_rows(codes, answer):
    assert cv.cheapest_edits(codes) == answer
