"""SentencePiece encoding and decoding by a max-plus scan over chunks of giant documents.

A sequence of pieces is the byte-pair encoding of a text exactly if each neighbouring pair is
the encoding of the pair's own text.  So the encoding is the one path of weight 0 in a graph
whose nodes are pieces at positions and whose edges weigh 0 where two pieces go together and
minus infinity elsewhere.

A document of many chunks is cut at fixed places.  The state at a cut is the piece that covers
the last character before it.  Each chunk, for itself, yields a transfer matrix in the
max-plus semiring: the best weight from each state at its left cut to each state at its right
cut.  Products of matrices are associative, so runs of chunks are combined in parallel, the
states at all cuts are read off prefix and suffix products, and every chunk is backtraced by
itself between its two states.  With weights 0 and minus infinity alone, a row of a matrix is
the set of its finite entries; that is how rows are kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import partitions, stored
from .line_dedup import document_key

CHUNK = 32_768  # characters
BLOCK = 256  # chunks whose matrices are multiplied in one group
SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
KEPT = 100_000  # words, and pairs of pieces, that a task remembers at a time

State = tuple[int, int]  # characters of the piece before and after the cut
START: State = (0, 0)
Matrix = dict[State, set[State]]


class Pieces:
    """Pieces and scores of a byte-pair SentencePiece model with byte fallback."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE:
            raise ValueError("only byte-pair models are supported")
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        proto.normalizer_spec.add_dummy_prefix = False  # segments start inside a text too
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        kinds = pb.ModelProto.SentencePiece
        self.score = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.longest = max(map(len, self.score))
        # pieces never hold a space after another character: words are cut off from each other
        self.word_starts = not any(SPACE in p.lstrip(SPACE) for p in self.score)
        self.bytes = [
            bytes([int(p.piece[3:-1], 16)]) if p.type == kinds.BYTE
            else p.piece.replace(SPACE, " ").encode() if p.type == kinds.NORMAL else b""
            for p in proto.pieces
        ]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, list[int]] = {}

    def normal(self, text: str | None) -> str:
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def encode(self, segment: str) -> list[int]:
        """Ids of a normalised segment, word by word where no piece reaches across words."""
        if not self.word_starts:
            return self.processor.encode(segment)
        words, known = WORD.findall(segment), self.words
        if len(known) > KEPT:
            known.clear()
        new = [w for w in set(words) if w not in known]
        if new:
            known.update(zip(new, self.processor.encode(new, num_threads=1), strict=True))
        return list(chain.from_iterable(map(known.__getitem__, words)))

    def decode(self, ids: Iterable[int]) -> str:
        table = self.bytes
        text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text

    def merged(self, text: str) -> list[str]:
        """Encoding of a short text by merging: the best score first, then the leftmost."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def together(self, one: str, two: str) -> bool:
        """Whether the edge from a piece to the next has weight 0."""
        found = self.pairs.get((one, two))
        if found is None:
            if len(self.pairs) > KEPT:
                self.pairs.clear()
            found = self.pairs[one, two] = self.merged(one + two) == [one, two]
        return found

    def ends(self, text: str, start: int) -> list[int]:
        """Ends of the pieces that start here; a single character always is one."""
        stop = min(len(text), start + self.longest)
        return [start + 1, *(e for e in range(start + 2, stop + 1) if text[start:e] in self.score)]

    def fresh(self, text: str, at: int) -> bool:
        """Whether a word starts here, so that no piece reaches across."""
        return self.word_starts and 0 < at < len(text) and text[at] == SPACE and text[at - 1] != SPACE


def states_at(pieces: Pieces, text: str, cut: int) -> list[State]:
    """All pieces of ``text`` that cover the character before ``cut``."""
    found = []
    for start in range(max(0, cut - pieces.longest), cut):
        found += [(cut - start, e - cut) for e in pieces.ends(text, start) if e >= cut]
    return found


def _paths(pieces: Pieces, text: str, sources: dict[tuple[int, int], frozenset], stop: int) -> dict:
    """Max-plus forward pass: spans that cover ``stop``, with the sources they are reached from."""
    ending: dict[int, dict[tuple[int, int], frozenset]] = {}
    for span, names in sources.items():
        ending.setdefault(span[1], {})[span] = names
    done: dict[tuple[int, int], frozenset] = {}
    at = min(ending)
    while ending and at < stop:
        here = ending.pop(at, None)
        if here:
            for end in pieces.ends(text, at):
                piece = text[at:end]
                names = [n for (s, e), n in here.items() if s < 0 or pieces.together(text[s:e], piece)]
                if names:
                    target = done if end >= stop else ending.setdefault(end, {})
                    target[at, end] = frozenset().union(*names)
        at += 1
    for spans in ending.values():
        done.update(spans)
    return done


def transfer(pieces: Pieces, before: str, body: str, after: str, first: bool, last: bool) -> Matrix:
    """Transfer matrix of one chunk, given the characters around it."""
    text, left = before + body + after, len(before)
    right = left + len(body)
    entries = [START] if first else states_at(pieces, text, left)
    sources = {
        ((-1, 0) if e == START else (left - e[0], left + e[1])): frozenset([e]) for e in entries
    }
    start = _word_start(pieces, text, left + pieces.longest, right, 1)
    if start:
        # all that reaches a word start goes on alike: the matrix has rank one
        through = _paths(pieces, text, sources, start)
        alive = frozenset().union(*[n for (_, e), n in through.items() if e == start])
        sources = {(-1, _word_start(pieces, text, right - 1, start - 1, -1)): alive}
    exits = _paths(pieces, text, sources, right)
    matrix: Matrix = {}
    for (start, end), names in exits.items():
        if not last or end == right:
            for e in names:
                matrix.setdefault(e, set()).add((right - start, end - right))
    return matrix


def _word_start(pieces: Pieces, text: str, start: int, stop: int, step: int) -> int | None:
    return next((p for p in range(start, stop, step) if pieces.fresh(text, p)), None)


def product(one: Matrix, two: Matrix) -> Matrix:
    """Max-plus product."""
    both = {e: set().union(*(two.get(m, set()) for m in mids)) for e, mids in one.items()}
    return {e: x for e, x in both.items() if x}


def path(matrices: list[Matrix], entry: State, exit_: State) -> list[State]:
    """States at all cuts of the path from ``entry`` to ``exit_``: prefixes meet suffixes."""
    reached = [{entry}]
    for m in matrices:
        reached.append(set().union(*(m.get(s, set()) for s in reached[-1])))
    states = [exit_]
    for m, left in zip(reversed(matrices), reversed(reached[:-1]), strict=True):
        (state,) = (s for s in left if states[-1] in m.get(s, ()))
        states.append(state)
    return states[::-1]


def packed(matrix: Matrix) -> str:
    return json.dumps([[list(e), [list(x) for x in sorted(xs)]] for e, xs in sorted(matrix.items())])


def unpacked(text: str) -> Matrix:
    return {tuple(e): {tuple(x) for x in xs} for e, xs in json.loads(text)}


def end_state(matrices: Iterable[Matrix]) -> State:
    """The state at the end of a document: the only one that its start leads to."""
    reached = {START}
    for m in matrices:
        reached = set().union(*(m.get(s, set()) for s in reached))
    (state,) = reached
    return state


def read_model(path_: str) -> bytes:
    """The vocabulary file, read on the driver and sent to the tasks (its size is fixed)."""
    with open(path_, "rb") as file:
        return file.read()


SLICE = 256  # rows that a task turns into ids at a time


def encode(
    docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """``docs`` in a struct ``row``, with ``ids`` (array of int), the encoding of the whole text,
    and ``round_trip``, whether decoding the ids gives the text (its space signs as spaces).

    NULL and empty texts have no ids.  Rows that repeat an id and a text get the same ids each.
    An empty table gives no rows; other columns are carried along unread.
    """
    if chunk < 64:
        raise ValueError("a chunk is longer than two of the longest pieces")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(0).field(text_col).to_pylist()
                ids = [np.array(p.encode(p.normal(t)), np.int32) for t in texts]
                same = [p.decode(i) == (t or "").replace(SPACE, " ") for t, i in zip(texts, ids, strict=True)]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate([*ids, np.empty(0, np.int32)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, flat), pa.array(same, pa.bool_())],
                    names=["row", "ids", "round_trip"],
                )

    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col(text_col).alias("text"),
        F.to_json(document_key(id_col, text_col)).alias("key"),
    )
    giant = F.coalesce(F.length("text"), F.lit(0)) + 1 >= 2 * chunk
    encoded_type = T.StructType(
        [
            T.StructField("row", rows.schema["row"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    small = rows.filter(~giant).select("row").mapInArrow(whole, encoded_type)

    # giant documents: chunks with the characters around them
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = Pieces(shared.value)
        for frame in frames:
            for key, text in zip(frame["key"], frame["text"], strict=True):
                t, reach = p.normal(text), p.longest
                n = len(t) // chunk
                for i in range(n):
                    a, b = i * chunk, (i + 1) * chunk if i < n - 1 else len(t)
                    yield pd.DataFrame(
                        {"key": [key], "k": [i], "n": [n], "before": [t[max(0, a - reach) : a]],
                         "body": [t[a:b]], "after": [t[b : b + reach]]}
                    )

    chunks = stored(
        rows.filter(giant).select("key", "text").dropDuplicates(["key"])
        .mapInPandas(cut, "key string, k int, n int, before string, body string, after string")
        .repartition(partitions(spark), "key", "k")
    )

    def matrices_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = Pieces(shared.value)
        for f in frames:
            f["matrix"] = [
                packed(transfer(p, b, x, a, k == 0, k == n - 1))
                for b, x, a, k, n in zip(f["before"], f["body"], f["after"], f["k"], f["n"], strict=True)
            ]
            f["block"] = f["k"] // BLOCK
            yield f[["key", "block", "k", "matrix"]]

    matrices = stored(chunks.mapInPandas(matrices_of, "key string, block int, k int, matrix string"))

    def in_block(frame: pd.DataFrame) -> pd.DataFrame:
        ms = [unpacked(m) for m in frame.sort_values("k")["matrix"]]
        total = ms[0]
        for m in ms[1:]:
            total = product(total, m)
        return pd.DataFrame({"key": frame["key"][:1], "block": frame["block"][:1], "matrix": packed(total)})

    def across(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        ms = [unpacked(m) for m in frame["matrix"]]
        states = path(ms, START, end_state(ms))
        return pd.DataFrame(
            {"key": frame["key"], "block": frame["block"],
             "entry": [json.dumps(s) for s in states[:-1]], "exit": [json.dumps(s) for s in states[1:]]}
        )

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("k")
        ends = [tuple(json.loads(frame[c].iloc[0])) for c in ("entry", "exit")]
        states = path([unpacked(m) for m in frame["matrix"]], *ends)
        return pd.DataFrame(
            {"key": frame["key"], "k": frame["k"], "skip": [s[1] for s in states[:-1]], "over": [s[1] for s in states[1:]]}
        )

    # a text has below 2**31 bytes, so a group holds at most 256 blocks of 256 chunks
    blocks = matrices.groupBy("key", "block").applyInPandas(in_block, "key string, block int, matrix string")
    ends = blocks.groupBy("key").applyInPandas(across, "key string, block int, entry string, exit string")
    states = (
        matrices.join(ends, ["key", "block"])
        .groupBy("key", "block")
        .applyInPandas(within, "key string, k int, skip int, over int")
    )

    def backtraced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = Pieces(shared.value)
        for f in frames:
            ids = [
                p.encode(x[skip:] + a[:over])
                for x, a, skip, over in zip(f["body"], f["after"], f["skip"], f["over"], strict=True)
            ]
            yield pd.DataFrame({"key": f["key"], "k": f["k"], "ids": ids})

    parts = chunks.join(states, ["key", "k"]).mapInPandas(backtraced, "key string, k int, ids array<int>")
    encoded = parts.groupBy("key").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])
        ).alias("ids")
    )
    large = rows.filter(giant).join(encoded, "key").select("row", "text", "ids")
    same = F.col("decoded") == F.translate("text", SPACE, " ")
    large = decode(large, model).select("row", "ids", same.alias("round_trip"))
    return small.union(large)


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids; NULL has NULL."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        p = Pieces(shared.value)
        for batch in batches:
            yield pd.Series([None if ids is None else p.decode(ids) for ids in batch], dtype=object)

    decoder = F.pandas_udf(mapped, T.StringType())
    return encoded.withColumn("decoded", decoder(F.col(ids_col)))
