"""Language identification by words, backing off to character n-grams.

A word that the model knows scores by its log frequency in each language.  An unseen word
falls back to its character 5-grams; a 5-gram that is unseen gives way to the 4-grams inside,
and so on down to single characters.  A document takes the language with the largest sum.

The counts are taken on a bounded sample of labelled rows (``SAMPLE`` distinct texts per
language, chosen by a hash of the text).  Every label becomes a language.  A piece is known in a language
if it makes up a fixed least share of the pieces of its length there, so no piece is ranked
against others, no language takes another's place, and the model has at most ``ENTRIES``
entries of twelve bytes.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

SAMPLE = 2_000  # labelled texts per language, about, that the counts are taken on
ENTRIES = 12_000_000  # (piece, language) pairs of a model, at most
PIECES = 100_000  # known words, and known n-grams of each length, per language, at most
GRAMS = (5, 4, 3, 2, 1)
MIN_COUNT = 2  # a word seen once says no more than its n-grams do
SMOOTH = 0.5
BROADCAST_ROWS = 100_000  # languages with a share of their own that go to every task
UNDETERMINED = "und"
KEPT_CELLS = 1_200_000  # scores of words by language that a task remembers at a time
TOGETHER = 50_000  # words of neighbouring texts whose new ones are learned at once
SEED = 42  # of Spark's xxhash64


def _classes(*groups: tuple[str, ...]) -> list[str]:
    """For each group of Unicode categories, the ranges of a character class that hold its code points."""
    codes: dict[str, list[int]] = {k: [] for group in groups for k in group}
    for c, kind in enumerate(map(unicodedata.category, map(chr, range(sys.maxunicode + 1)))):
        if kind in codes:
            codes[kind].append(c)
    out = []
    for group in groups:
        own = sorted(c for kind in group for c in codes[kind])
        cuts = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1] + 1), len(own)]
        out.append("".join(f"{chr(own[a])}-{chr(own[b - 1])}" for a, b in zip(cuts, cuts[1:])))
    return out


# a word is a letter and the letters and combining marks after it, in training and in scoring alike
_NUMBERS, _MARKS = _classes(("No", "Nl"), ("Mn", "Mc", "Me"))
_LETTER = rf"[^\W\d_{_NUMBERS}]"
_MARKED = re.compile(f"{_LETTER}+(?:[{_MARKS}]+{_LETTER}*)*")
_PLAIN = re.compile(r"[^\W\d_]+")  # the same in texts without marks and other numbers, and faster
_ODD = frozenset(re.findall(f"[{_NUMBERS}{_MARKS}]", "".join(map(chr, range(sys.maxunicode + 1)))))


def words_of(text: str | None) -> list[str]:
    """The words of a text, in lower case."""
    text = (text or "").lower()
    return (_PLAIN if text.isascii() or _ODD.isdisjoint(text) else _MARKED).findall(text)


JAVA_LETTERS = r"\p{L}[\p{L}\p{M}]*"


def train_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, size, piece, n): size 0 for words, else the length of an n-gram.

    Rows without a language or text teach nothing, and equal texts of a language teach once.
    Words are lower-cased runs of letters; n-grams are taken from the words with ``_`` at both
    ends, each word as often as it stands.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("draw")
    )
    texts = labelled.groupBy("lang").agg(F.approx_count_distinct("draw").alias("texts"))
    # a share of the texts of each language that has more; nothing is gathered to be sorted
    shares = stored(
        texts.filter(F.col("texts") > SAMPLE).select(
            F.xxhash64("lang").alias("lang_key"), (F.lit(float(SAMPLE)) / F.col("texts")).alias("share")
        )
    )
    if shares.count() <= BROADCAST_ROWS:  # two numbers a row; more languages than that meet in a shuffle
        shares = F.broadcast(shares)
    sample = (
        labelled.withColumn("lang_key", F.xxhash64("lang"))
        .join(shares, "lang_key", "left")
        .filter(F.pmod("draw", F.lit(1 << 31)) < F.coalesce("share", F.lit(1.0)) * (1 << 31))
        .select("lang", "text")
        .distinct()
    )
    words = (
        sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(JAVA_LETTERS), F.lit(0))).alias("piece"))
        .groupBy("lang", "piece")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    framed = F.concat(F.lit("_"), F.col("piece"), F.lit("_"))

    def grams_of(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(framed) - (size - 1)))
        return F.transform(
            starts, lambda i: F.struct(F.lit(size).alias("size"), F.substring(framed, i, size).alias("piece"))
        )

    grams = [grams_of(size) for size in GRAMS]
    parts = (
        words.select("lang", "n", F.explode(F.concat(*grams)).alias("g"))
        .filter(F.length("g.piece") == F.col("g.size"))
        .groupBy("lang", F.col("g.size").alias("size"), F.col("g.piece").alias("piece"))
        .agg(F.sum("n").alias("n"))
    )
    return words.select("lang", F.lit(0).alias("size"), "piece", "n").union(parts)


def _hashed(pieces: list[str]) -> np.ndarray:
    """The hashes that Spark's ``xxhash64`` gives these pieces."""
    found = (xxhash.xxh64_intdigest(p.encode("utf-8", "replace"), SEED) for p in pieces)
    return np.fromiter(found, np.uint64, len(pieces))


class Table:
    """Known pieces of one length: sorted hashes, and the languages that each was seen in."""

    def __init__(self, hashes: np.ndarray, langs: np.ndarray, counts: np.ndarray, n_langs: int) -> None:
        order = np.lexsort((langs, hashes))
        hashes, self.langs, counts = hashes[order], langs[order].astype(np.int32), counts[order].astype(np.float64)
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        self.hashes = hashes[new]
        self.cuts = np.append(np.flatnonzero(new), len(hashes))
        totals = np.bincount(self.langs, counts, n_langs)
        scale = np.log(totals + SMOOTH * max(1, len(self.hashes)))
        # the log frequency of a piece not seen in a language, and what a seen one adds to it
        self.floor = np.log(SMOOTH) - scale
        self.gain = (np.log(counts + SMOOTH) - np.log(SMOOTH)).astype(np.float32)

    def places(self, pieces: list[str]) -> np.ndarray:
        """Row of each piece, -1 for the unknown."""
        if not len(self.hashes) or not pieces:
            return np.full(len(pieces), -1, np.int64)
        hashes = _hashed(pieces)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def entries(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``places``, entry) of all entries of known pieces."""
        sizes = self.cuts[places + 1] - self.cuts[places]
        of = np.repeat(np.arange(len(places)), sizes)
        first = np.repeat(self.cuts[places] - np.cumsum(sizes) + sizes, sizes)
        return of, first + np.arange(len(of))


class Model:
    """Languages, and a table of known pieces for words (0) and for n-grams of each length."""

    def __init__(self, langs: list[str], tables: dict[int, Table]) -> None:
        self.langs = langs
        self.tables = tables

    @classmethod
    def of_counts(cls, counts: dict[int, dict[str, dict[str, int]]]) -> Model:
        """The model of size -> piece -> language -> count."""
        langs = sorted({x for pieces in counts.values() for seen in pieces.values() for x in seen})
        rows = [
            (size, piece, langs.index(x), n)
            for size, pieces in counts.items() for piece, seen in pieces.items() for x, n in seen.items()
        ]
        sizes = np.array([r[0] for r in rows], np.int64)
        return cls.of_rows(
            langs, sizes, _hashed([r[1] for r in rows]),
            np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64),
        )

    @classmethod
    def of_rows(
        cls, langs: list[str], sizes: np.ndarray, hashes: np.ndarray, at: np.ndarray, counts: np.ndarray
    ) -> Model:
        tables = {}
        for size in (0, *GRAMS):
            mine = sizes == size
            tables[size] = Table(hashes[mine], at[mine], counts[mine], len(langs))
        return cls(langs, tables)

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores by word and language, whether anything of the word is known); words in lower case."""
        n_langs = len(self.langs)
        out = np.zeros(len(words) * n_langs)
        seen = np.zeros(len(words), np.int64)

        def add(size: int, of: np.ndarray, pieces: list[str]) -> np.ndarray:
            table = self.tables[size]
            places = table.places(pieces)
            hit = places >= 0
            hits = of[hit]
            times = np.bincount(hits, minlength=len(words))
            nonlocal out, seen
            seen += times
            out += np.outer(times, table.floor).ravel()
            at, entry = table.entries(places[hit])
            out += np.bincount(hits[at] * n_langs + table.langs[entry], table.gain[entry], len(out))
            return ~hit

        rest = np.flatnonzero(add(0, np.arange(len(words)), words)).tolist()
        framed = {i: f"_{words[i]}_" for i in rest}
        starts = {}
        for i, text in framed.items():
            size = min(GRAMS[0], len(text))
            starts.setdefault(size, {})[i] = range(len(text) - size + 1)
        for size in GRAMS:
            asked = [(i, k) for i, places in starts.get(size, {}).items() for k in places]
            if not asked:
                continue
            of = np.array([i for i, _ in asked], np.int64)
            unseen = add(size, of, [framed[i][k : k + size] for i, k in asked])
            # an unseen n-gram gives way to the two inside it
            below = starts.setdefault(size - 1, {})
            inside: dict[int, set[int]] = {}
            for j in np.flatnonzero(unseen).tolist():
                i, k = asked[j]
                inside.setdefault(i, set()).update((k, k + 1))
            below.update({i: sorted(ks) for i, ks in inside.items()})
        return out.reshape(len(words), n_langs) / np.maximum(seen, 1)[:, None], seen > 0

    def shares(self, words: list[str]) -> np.ndarray:
        """By word and language: 1 if the word was seen in it, else the share of its 3-grams that were."""
        n_langs = len(self.langs)
        of, grams = [], []
        for i, word in enumerate(words):
            framed = f"_{word}_"
            of += [i] * (len(framed) - 2)
            grams += [framed[k : k + 3] for k in range(len(framed) - 2)]
        of_gram = np.array(of, np.int64)
        places = self.tables[3].places(grams)
        hits = of_gram[places >= 0]
        at, entry = self.tables[3].entries(places[places >= 0])
        out = np.bincount(hits[at] * n_langs + self.tables[3].langs[entry], minlength=len(words) * n_langs)
        out = out.reshape(len(words), n_langs) / np.bincount(of_gram, minlength=len(words))[:, None]
        places = self.tables[0].places(words)
        hits = np.flatnonzero(places >= 0)
        at, entry = self.tables[0].entries(places[hits])
        out[hits[at], self.tables[0].langs[entry]] = 1.0
        return out


class Scorer:
    """Scores texts by a model; remembers the scores of words, a bounded number at a time."""

    def __init__(self, model: Model, known: bool = False) -> None:
        self.model = model
        self.with_known = known
        self.room = max(256, KEPT_CELLS // max(1, len(model.langs)))
        self._forget()

    def _forget(self) -> None:
        width = len(self.model.langs)
        self.places: dict[str, int] = {}
        self.rows = np.zeros((0, width), np.float32)
        self.any = np.zeros(0, bool)
        self.shares = np.zeros((0, width), np.float32)
        self.n = 0

    def _learn(self, words: list[str]) -> None:
        scores, seen = self.model.scores(words)
        if self.n + len(words) > len(self.rows):
            size = max(1024, 2 * len(self.rows), self.n + len(words))
            for name in ("rows", "any", "shares")[: 2 + self.with_known]:
                old = getattr(self, name)
                grown = np.zeros((size, *old.shape[1:]), old.dtype)
                grown[: self.n] = old[: self.n]
                setattr(self, name, grown)
        new = slice(self.n, self.n + len(words))
        self.rows[new], self.any[new] = scores, seen
        if self.with_known:
            self.shares[new] = self.model.shares(words)
        self.places.update(zip(words, range(new.start, new.stop), strict=True))
        self.n = new.stop

    def __call__(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float, float]]:
        """For each text its language, its score, and how far it consists of what was seen in that language.

        The last is the mean of its words, 0 to 1; it does not depend on the number of languages
        and is 0 unless the scorer was made for it.
        """
        held: list[list[str]] = []
        n = 0
        for text in texts:
            held.append(words_of(text))
            n += len(held[-1])
            if n >= TOGETHER:
                yield from self._together(held)
                held, n = [], 0
        yield from self._together(held)

    def _together(self, texts: list[list[str]]) -> Iterator[tuple[str, float, float]]:
        """Results of some texts, whose new words are learned at once."""
        if self.model.langs:
            if self.n > self.room:
                self._forget()
            unseen = set().union(*texts).difference(self.places)
            if unseen and len(unseen) <= self.room:
                self._learn(sorted(unseen))
        return map(self._one, texts)

    def _one(self, words: list[str]) -> tuple[str, float, float]:
        langs = self.model.langs
        if not words or not langs:
            return UNDETERMINED, 0.0, 0.0
        total, known, n = np.zeros(len(langs)), np.zeros(len(langs)), 0
        for start in range(0, len(words), self.room):  # a long text's words need not be held at once
            part = words[start : start + self.room]
            unseen = set(part).difference(self.places)
            if unseen:
                if self.n > self.room:
                    self._forget()
                    unseen = set(part)
                self._learn(sorted(unseen))
            at = np.fromiter(map(self.places.__getitem__, part), np.int64, len(part))
            total += self.rows[at].sum(axis=0, dtype=np.float64)
            n += int(np.count_nonzero(self.any[at]))
            if self.with_known:
                known += self.shares[at].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())  # the first of ties
        # the mean per word, so that the score does not run to 1 with the length of the text
        score = float(1 / np.exp((total - total[best]) / max(n, 1)).sum())
        return langs[best], score, min(1.0, float(known[best]) / len(words))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of ``docs``; it fetches at most ``ENTRIES`` counts, a hash and two numbers each.

    Pieces are told apart by 64-bit hashes.  With many languages each gets an equal part of the
    entries: a piece counts where it makes up at least one part in so many.
    """
    counts = train_counts(docs, text_col, lang_col).filter(F.col("n") >= MIN_COUNT)
    counts = stored(counts.select("lang", F.col("size").cast("int"), F.xxhash64("piece").alias("piece"), "n"))
    n_langs = counts.agg(F.countDistinct("lang")).first()[0]
    room = max(1, min(PIECES, ENTRIES // (max(1, n_langs) * (1 + len(GRAMS)))))
    totals = counts.groupBy("lang", "size").agg((F.sum("n") / room).alias("least"))
    top = counts.join(totals, ["lang", "size"]).filter(F.col("n") >= F.col("least"))
    found = top.select("lang", "size", "piece", "n").toArrow()
    names = found["lang"].combine_chunks().dictionary_encode()
    order = np.argsort(np.array(names.dictionary.to_pylist(), object)) if len(names.dictionary) else np.zeros(0, int)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by_place = sorted(names.dictionary.to_pylist())
    at = rank[names.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
    return Model.of_rows(
        by_place,
        found["size"].to_numpy().astype(np.int64),
        found["piece"].to_numpy().astype(np.int64).view(np.uint64),
        at,
        found["n"].to_numpy().astype(np.int64),
    )


def language_id(
    docs: DataFrame, model: Model, text_col: str = "text", known: bool = False
) -> DataFrame:
    """``docs`` in a struct ``row``, with lang_pred and score (0 to 1).

    The score falls with the number of languages that come near.  ``known`` adds a column of
    that name: how far the text consists of words and 3-grams seen in lang_pred (0 to 1).

    Only the text is looked at, all of it.  ``und`` with score 0 where the text is NULL or has
    no letter, or where the model learned nothing.  Letters that the model has never seen give
    the first language with an even score, as do ties.  Repeated rows get the same result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def mapped(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = Scorer(shared.value, known)
        names = ["lang_pred", "score", *["known"] * known]
        for batch in texts:
            found = pd.DataFrame(list(score(batch)), columns=["lang_pred", "score", "known"])
            yield found[names]

    columns = ["lang_pred string", "score double", *["known double"] * known]
    # nondeterministic to the optimiser: a filter on the result must not run the scorer once more
    predicted = F.pandas_udf(mapped, ", ".join(columns)).asNondeterministic()
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), predicted(F.col(text_col)).alias("found")
    ).select("row", "found.*")
