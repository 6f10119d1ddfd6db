"""Repair of damaged conversations by the cheapest edits, the least audit among equals.

The edits of a conversation are paths through a lattice: its rows so far, and what the last
role given out was.  Dijkstra's search runs from both ends; when its heaps have met, it goes on
until no crossing of the same cost is left, so that every cheapest path is known, and of these
the one is walked whose edit letters come first.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SPACES, stored

ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5  # costs; CUT_OFF: a truncated row that stays
SOUND, TRUNCATED, GONE = range(3)  # rows: fine, cut off, to be deleted
INITIALS = "sua"  # 1, 2, 3 in a row's code; 0 is any other role
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(1, 2), (2, 3), (3, 2)}
KNOWN_CONVERSATIONS = 100_000  # answers for short conversations that a task remembers
SHORT = 32


# ---------------------------------------------------------------- one conversation
def _after(state: int) -> int:
    """The state after giving out the role that may follow, user first."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: int) -> int | None:
    """The state after keeping a row with that initial; None where it may not stand."""
    if initial == SYSTEM:
        return SYSTEM if state == START else None
    return initial if initial and initial == _after(state) else None


def _tables() -> tuple[list[list[list[tuple[str, int, int]]]], list[list[list[tuple[int, int]]]]]:
    """By row code and state: (letter, cost, state after) of the edits of a row; and the same backwards."""
    ahead = [[[("D", DELETE, q)] for q in range(4)] for _ in range(12)]
    back: list[list[list[tuple[int, int]]]] = [[[] for _ in range(4)] for _ in range(12)]
    for code in range(12):
        initial, fault = divmod(code, 3)
        for q in range(4):
            if fault != GONE:
                extra = CUT_OFF * (fault == TRUNCATED)
                if (to := _kept(q, initial)) is not None:
                    ahead[code][q].append(("K", KEEP + extra, to))
                ahead[code][q].append(("R", REROLE + extra, _after(q)))
            for _, cost, to in ahead[code][q]:
                back[code][to].append((cost, q))
    return ahead, back


AHEAD, BACK = _tables()
BEFORE = [[q for q in range(4) if _after(q) == to] for to in range(4)]  # states an insertion leads from


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of rows ``codes`` (3 * initial + fault each).

    Of audits of equal cost the least in ASCII order.  Time and memory grow with the rows.
    """
    n = len(codes)
    last, far = 4 * n, 1 << 60
    ahead, back = [far] * (last + 4), [far] * (last + 4)  # distances from the start and to an end
    size = last + 4
    forward, reverse = [START], [last + START, last + ASSISTANT]  # heaps of distance * size + node
    ahead[START] = back[last + START] = back[last + ASSISTANT] = 0
    least = back[START]  # 0 where there are no rows: the start is an end
    while forward and reverse and forward[0] // size + reverse[0] // size <= least:
        if forward[0] // size <= reverse[0] // size:
            d, node = divmod(heapq.heappop(forward), size)
            if d > ahead[node]:
                continue
            i, q = divmod(node, 4)
            steps = [(INSERT, 4 * i + _after(q))]
            if i < n:
                steps += [(cost, 4 * i + 4 + to) for _, cost, to in AHEAD[codes[i]][q]]
            mine, other, heap = ahead, back, forward
        else:
            d, node = divmod(heapq.heappop(reverse), size)
            if d > back[node]:
                continue
            i, q = divmod(node, 4)
            steps = [(INSERT, 4 * i + p) for p in BEFORE[q]]
            if i:
                steps += [(cost, 4 * i - 4 + p) for cost, p in BACK[codes[i - 1]][q]]
            mine, other, heap = back, ahead, reverse
        for cost, to in steps:
            if d + cost < mine[to]:
                mine[to] = d + cost
                heapq.heappush(heap, (d + cost) * size + to)
                least = min(least, d + cost + other[to])

    # from every crossing back to the start over exact distances: what is still to go is known there too
    waiting = [v for v in range(size) if ahead[v] + back[v] == least]
    while waiting:
        i, q = divmod(v := waiting.pop(), 4)
        steps = [(INSERT, 4 * i + p) for p in BEFORE[q]]
        if i:
            steps += [(cost, 4 * i - 4 + p) for cost, p in BACK[codes[i - 1]][q]]
        for cost, u in steps:
            if ahead[u] + cost == ahead[v] and back[u] != least - ahead[u]:
                back[u] = least - ahead[u]
                waiting.append(u)
    audit, i, q, left = [], 0, START, least
    while left or i < n:
        steps = [("I", INSERT, 4 * i + _after(q))]
        if i < n:
            steps += [(letter, cost, 4 * i + 4 + to) for letter, cost, to in AHEAD[codes[i]][q]]
        letter, cost, node = min(s for s in steps if back[s[2]] == left - s[1])
        audit.append(letter)
        left -= cost
        i, q = divmod(node, 4)
    return least, "".join(audit)


def repaired(rows: Iterator[tuple[str, str, int]], audit: str) -> str:
    """SHA-256 of the repaired ``role:text`` lines; ``rows`` are (role, text, times).

    The lines go into the hash one by one, and are nowhere together.
    """
    total, state, at, first = hashlib.sha256(), START, 0, True

    def give(name: str, text: str) -> None:
        nonlocal first
        total.update(f"{'' if first else chr(10)}{name}:{text}".encode("utf-8", "replace"))
        first = False

    for role, text, times in rows:
        for _ in range(times):
            while audit[at] == "I":
                state, at = _after(state), at + 1
                give(NAMES[state], "")
            letter, at = audit[at], at + 1
            if letter == "K":
                state = _kept(state, INITIALS.find(role[:1]) + 1 if role else 0)
                give(role, text)
            elif letter == "R":
                state = _after(state)
                give(NAMES[state], text)
    for _ in audit[at:]:
        state = _after(state)
        give(NAMES[state], "")
    return total.hexdigest()


# ---------------------------------------------------------------- all conversations
def damage(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with the faults that a hash of id and turn deals out.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 removes its full
    stops, exclamation and question marks, 3 repeats it, 4 makes it the user's.  NULLs read as
    one space, in the hash and in role and text.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.translate(plain("text"), ENDS, ""))
    rows = turns.select("conv_id", "turn", "role", "text", dealt.alias("dealt")).filter("dealt <> 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("dealt") == 4, "user").otherwise(plain("role")).alias("role"),
        text.otherwise(plain("text")).alias("text"),
        F.explode(F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def row_faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times, blank, later, truncated), equal rows folded into one.

    ``later``: role and text stand at an earlier turn of the conversation.  Both counts combine
    on the map side, and only texts that a conversation says twice meet a join.
    """
    folded = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times"))
    said = F.sha2("text", 256)
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (
        folded.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), said.alias("said"))
        .agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("places"))
        .filter("places > 1")
    )
    same = folded["conv_id"].eqNullSafe(first["c"]) & (folded["role"] == first["r"]) & (said == first["said"])
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    return folded.join(first, same, "left").select(
        "conv_id", "turn", "role", "text", "times",
        (bare == "").alias("blank"),
        F.coalesce(F.col("first") < at, F.lit(False)).alias("later"),
        (~F.right(bare, F.lit(1)).isin(*ENDS)).alias("truncated"),
    )


_SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _searched(id_type: pa.DataType):
    """Function for mapInArrow: sorted rows in; counts, cost and audit of each conversation out."""
    schema = pa.schema([("conv_id", id_type), *((s, pa.int64()) for s in _SUMS), ("audit", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {}
        out: list[tuple] = []
        size = 0
        for conv, own in groupby(rows(batches), key=lambda r: r[0]):
            codes = bytearray()
            gaps = blank = duplicate = truncated = illegal = distinct = 0
            low = high = before = None
            for _, kind, turn, initial, times, is_blank, later, cut in own:
                if not kind:
                    continue  # names the conversation
                if turn is not None and turn != high:
                    low, high, distinct = turn if low is None else low, turn, distinct + 1
                fault = GONE if is_blank or later else TRUNCATED if cut else SOUND
                blank += times if is_blank else 0
                duplicate += 0 if is_blank else times if later else times - 1
                truncated += fault == TRUNCATED
                illegal += times - 1 + (before is not None and (before, initial) not in LEGAL)
                before = initial
                codes.append(3 * initial + fault)
                codes += bytes([3 * initial + GONE]) * (times - 1)
            if distinct:
                gaps = high - low + 1 - distinct
            key = bytes(codes)
            found = known.get(key) or cheapest_edits(key)
            if len(key) <= SHORT:
                if len(known) > KNOWN_CONVERSATIONS:
                    known.clear()
                known[key] = found
            out.append((conv, gaps, blank, duplicate, truncated, illegal, *found))
            size += len(found[1]) + 64
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return mapped


def _hashed(id_type: pa.DataType):
    """Function for mapInArrow: each conversation's audit and then its rows in; its hash out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed() -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in out], id_type)]
            columns += [pa.array([r[1][s] for r in out], pa.int64()) for s in _SUMS]
            columns += [pa.array([r[1]["audit"] for r in out], pa.string()), pa.array([r[2] for r in out], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", *_SUMS, "audit", "repaired_sha256"])

        out: list[tuple] = []
        for conv, own in groupby(rows(batches), key=lambda r: r[0]):
            answer = next(own)[2]  # the audit comes first, then the rows in their order
            out.append((conv, answer, repaired(((r[3], r[4], r[5]) for r in own), answer["audit"])))
            if len(out) == 2_000 or len(answer["audit"]) > 1 << 20:
                yield closed()
                out = []
        if out:
            yield closed()

    return mapped


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` holds conv_id, turn, role, text; a conversation's rows are taken by turn (NULL
    first), rows of one turn by role and text in byte order; a NULL role or text is one space;
    rows without a conv_id are one conversation.  ``conversations`` (conv_id) adds those that
    have no rows: zeros, no audit, the hash of nothing.  Equal rows are repeated rows: all but
    the first are duplicates.  Other columns are not read; no rows give no rows.

    A conversation's rows pass through one task in sorted batches, because its hash is a running
    one; only a byte a row and the distances of the search stand in memory.
    """
    plain = turns.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    ids = plain.select("conv_id") if conversations is None else conversations.select("conv_id")
    rows = stored(row_faults(plain))
    named = ids.distinct()
    kind = rows.schema["conv_id"].dataType
    initial = F.instr(F.lit(INITIALS), F.left("role", F.lit(1)))
    marks = rows.select(
        "conv_id", F.lit(1).alias("kind"), "turn",
        F.when(F.col("role") == "", 0).otherwise(initial).alias("initial"),
        "times", "blank", "later", "truncated", "role", "text",
    )
    order = [F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "text"]
    sorted_marks = (
        marks.unionByName(named.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        .repartition("conv_id").sortWithinPartitions(*order).drop("role", "text")
    )
    from pyspark.sql.pandas.types import to_arrow_type

    id_type, name = to_arrow_type(kind), kind.simpleString()
    ddl = f"conv_id {name}, " + ", ".join(f"{s} long" for s in _SUMS) + ", audit string"
    found = stored(sorted_marks.mapInArrow(_searched(id_type), ddl))
    answers = found.select("conv_id", F.lit(0).alias("kind"), F.struct(*_SUMS, "audit").alias("answer"))
    lines = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "times")
    sorted_lines = (
        lines.unionByName(answers, allowMissingColumns=True)
        .repartition("conv_id").sortWithinPartitions(*order)
        .select("conv_id", "kind", "answer", "role", "text", "times")
    )
    return sorted_lines.mapInArrow(_hashed(id_type), f"{ddl}, repaired_sha256 string")
