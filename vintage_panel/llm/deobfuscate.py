"""Noisy-channel restoring of disguised words: leetspeak, spacing and repetition.

A disguised stretch of text is a lattice of readings: a digit or symbol stands for itself or for
a letter that looks like it, a gap between single letters is one or is none, a run of one letter
is one, two or all of them.  Viterbi's search takes the reading that a character language model,
counted on the corpus, and the costs of the disguises find likeliest.  All other text stays.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# fixed values: the letters that digits and symbols stand for
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "*": "aeiouy",
}
EDGES = ".,;:!?\"'()[]{}«»„“”…*"  # no letters where they open or end a word
SEPARATORS = " ._-*"
# costs of the disguises, in nats: what is rare in honest text must earn its place
LOOKALIKE, MASKED, DROPPED, JOINED, SPLIT, TWICE, REPEATED = 1.0, 3.0, 4.0, 0.7, 0.5, 3.0, 0.5

EDGE, OTHER, N = 0, 27, 28  # symbols of the language model: word edge, a to z, anything else
ORDER = 4
CHARS = 1 << 20  # characters that a task counts at a time
KEPT = 100_000  # readings that a task remembers at a time

SPACED = re.compile(rf"\S(?:[{re.escape(SEPARATORS)}]\S(?!\w))+")
SPACE = re.compile(r"\s")
CUT = re.compile(r"\S\S\s(?=\S\S)")  # where a long text may be cut without parting a stretch
WIDTH = 0x2100  # code points below it are looked up; those beyond count as letters


def _symbol(char: str) -> int:
    if char.isspace():
        return EDGE
    base = unicodedata.normalize("NFKD", char.lower())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return OTHER if char in LOOKS or char.isalnum() else EDGE


#: Latin letters without their marks; beyond the table every character is OTHER
TABLE = np.array([_symbol(chr(c)) for c in range(WIDTH)] + [OTHER], np.uint8)
# what a character may be part of: bits
LETTER, LOOKALIKES, INSIDE, BETWEEN, BLANK, WORD = (1 << k for k in range(6))


def _kind(char: str) -> int:
    return (
        LETTER * char.isalpha() | LOOKALIKES * (char in LOOKS and char not in "!(*") | INSIDE * (char in "!(*")
        | BETWEEN * (char in SEPARATORS) | BLANK * char.isspace() | WORD * (char.isalnum() or char == "_")
    )


KINDS = np.array([_kind(chr(c)) for c in range(WIDTH)] + [LETTER | WORD], np.uint8)


def _places(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.minimum(codes, WIDTH)


def symbols(text: str) -> np.ndarray:
    """Symbols of the language model, one a character."""
    return TABLE[_places(text)].astype(np.int64)


def disguises(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where a stretch may be disguised, and where single characters stand apart.

    A look-alike beside a letter, a mark between two, a letter three times, or single characters
    with separators around them.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    # nothing beyond either end, so that every place has two neighbours on both sides
    kinds = np.pad(KINDS[np.minimum(codes, WIDTH)], 2, constant_values=BLANK)
    k, after, before = kinds[2:-2], kinds[3:-1], kinds[1:-3]
    beside = (before | after) & LETTER > 0
    found = (k & LOOKALIKES > 0) & beside | (k & INSIDE > 0) & (before & after & LETTER > 0)
    same = codes[1:] == codes[:-1]
    found[:-2] |= same[1:] & same[:-1] & (k[:-2] & LETTER > 0)
    # blank or start, character, separator, character, separator
    apart = (before & BLANK > 0) & (k & (BLANK | BETWEEN) == 0) & (after & BETWEEN > 0)
    apart &= (kinds[4:] & (BLANK | BETWEEN) == 0)
    apart[:-3] &= k[3:] & BETWEEN > 0
    apart[-3:] = False
    return np.flatnonzero(found | apart), apart


# ---------------------------------------------------------------- language model
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Function for mapInArrow: texts in, (cell, n) of their symbol 4-grams out."""
    total = np.zeros(N**ORDER, np.int64)
    pad = "   "  # edges before and after each text

    def add(text: str) -> None:
        s = symbols(text)
        cells = ((s[:-3] * N + s[1:-2]) * N + s[2:-1]) * N + s[3:]
        np.add(total, np.bincount(cells, minlength=N**ORDER), out=total)

    for batch in batches:
        waiting, size = [], 0
        for text in batch.column(0).to_pylist():
            text = f"{pad}{(text or '').lower()}"
            if len(text) > CHARS:  # in pieces that overlap by three
                for at in range(0, len(text), CHARS):
                    add(text[max(0, at - 3) : at + CHARS] + (pad if at + CHARS >= len(text) else ""))
                continue
            waiting.append(text)
            size += len(text)
            if size > CHARS:
                add("".join(waiting) + pad)
                waiting, size = [], 0
        if waiting:
            add("".join(waiting) + pad)
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total[cells], pa.int64())], names=["cell", "n"])


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Negative log likelihoods by three symbols and the next, counted over every whole text.

    Witten-Bell: a context backs off as far as it was followed by few different symbols.  The
    table has 28 ** 4 cells whatever the corpus.
    """
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_counted, "cell int, n long")
    summed = counts.groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most 28 ** 4 rows
    seen = np.zeros(N**ORDER)
    seen[[r["cell"] for r in summed]] = [r["n"] for r in summed]
    return costs(seen)


def costs(seen: np.ndarray) -> np.ndarray:
    """The model of 4-gram counts."""
    grams = seen.reshape((N,) * ORDER)
    likely = np.full(N, 1.0 / N)
    for size in range(1, ORDER + 1):
        counts = grams.sum(axis=tuple(range(ORDER - size)))
        every = counts.sum(axis=-1, keepdims=True)
        kinds = np.maximum((counts > 0).sum(axis=-1, keepdims=True), 1)
        likely = (counts + kinds * likely) / (every + kinds)  # the shorter context's row fits by broadcasting
    return (-np.log(likely)).astype(np.float32).reshape(-1)


# ---------------------------------------------------------------- decoding
class Restorer:
    """Restores disguised words of texts; remembers readings, a bounded number at a time."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model
        self.known: dict[str, str] = {}

    def __call__(self, text: str | None) -> str:
        """The text in lower case, its disguised stretches read."""
        text, at, pieces = (text or "").lower(), 0, []
        while len(text) - at > CHARS and (cut := CUT.search(text, at + CHARS)):
            pieces.append(self._piece(text[at : cut.end()]))
            at = cut.end()
        pieces.append(self._piece(text[at:]))
        return "".join(pieces)

    def _piece(self, text: str) -> str:
        if not text:
            return text
        places, apart = disguises(text)
        out, done = [], 0
        for at in places.tolist():
            if at < done:
                continue
            if apart[at] and (whole := SPACED.match(text, at)):
                a, b = whole.span()
            else:
                a = at
                while a > done and not text[a - 1].isspace():
                    a -= 1
                after = SPACE.search(text, at)
                b = after.start() if after else len(text)
            out += [text[done:a], self.read(text[a:b])]
            done = b
        return "".join([*out, text[done:]]) if done else text

    def read(self, stretch: str) -> str:
        """The likeliest reading of one stretch; punctuation at its ends stays."""
        body = stretch.lstrip(EDGES)
        head = stretch[: len(stretch) - len(body)]
        core = body.rstrip(EDGES)
        tail = body[len(core) :]
        reading = self.known.get(core)
        if reading is None:
            reading = self._viterbi(core)
            if len(core) <= 64:
                if len(self.known) > KEPT:
                    self.known.clear()
                self.known[core] = reading
        return head + reading + tail

    def _edges(self, text: str) -> Iterator[list[tuple[str, float]]]:
        """For each character, or run of one letter, its readings and their costs."""
        i, n = 0, len(text)
        spaced = bool(SPACED.fullmatch(text))
        while i < n:
            char, j = text[i], i + 1
            while j < n and text[j] == char:
                j += 1
            run, after = j - i, j
            letters = LOOKS.get(char, "")
            if char == "*" and (run > 1 or spaced):
                letters = ""  # one star hides one letter
            if char in SEPARATORS and 0 < i and j < n and run == 1 and spaced and i % 2:
                yield [("", JOINED), (" ", SPLIT)]
            elif char.isalpha():
                ways = [(char, 0.0 if run == 1 else TWICE if run == 2 else REPEATED)]
                if run > 1:
                    ways.append((char * 2, 0.0 if run == 2 else REPEATED))
                if run == 3:
                    ways.append((char * 3, 0.0))
                yield ways
            else:
                cost = MASKED if char == "*" else LOOKALIKE
                ways = [(char * min(run, 3), 0.0)]
                ways += [(x, cost + (run > 1) * REPEATED) for x in letters]
                ways += [(x * 2, cost + REPEATED) for x in letters if run > 1]
                if not char.isalnum():
                    ways.append(("", DROPPED))
                yield ways
            i = after

    def _viterbi(self, text: str) -> str:
        best: dict[int, float] = {0: 0.0}  # the last three symbols, and the cost so far
        back: list[dict[int, tuple[int, str]]] = []
        model = self.model
        for ways in self._edges(text):
            readings = [(x, cost, symbols(x).tolist()) for x, cost in ways]
            now: dict[int, float] = {}
            came: dict[int, tuple[int, str]] = {}
            for context, so_far in best.items():
                for reading, cost, path in readings:
                    total, at = so_far + cost, context
                    for s in path:
                        cell = at * N + s
                        total += float(model[cell])
                        at = cell % N**3
                    if total < now.get(at, np.inf):
                        now[at], came[at] = total, (context, reading)
            best = now
            back.append(came)
        at = min(best, key=lambda c: (best[c] + float(model[c * N + EDGE]), c))
        out = []
        for came in reversed(back):
            at, reading = came[at]
            out.append(reading)
        return "".join(reversed(out))
