"""Personal data by weak supervision.

Labelers vote on candidate spans: regular expressions on their form, gazetteers of cue words,
and the context.  Expectation-maximisation estimates how reliable each labeler is from the
votes alone, and its posteriors train a span classifier on the shape and the words around.
The base patterns always count; the classifier adds spans that the base patterns miss.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000  # candidates, about, that the classifier is fitted on, chosen by a hash
FEATURES = 4096
ADD_FROM = 0.9  # probability from which a candidate that no base pattern has is added
STEPS = 50

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# possessive, and not begun inside a run of digits: linear on any text, with the same matches
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# candidates beside the base matches: spelled-out addresses and numbers without a plus sign
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}+"
    r"(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}+){1,8}"
)
LOCAL_NUMBER = re.compile(r"(?<![0-9+().-])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){2,4}(?![0-9.-])")

# fixed values: cue words before a span
CUES = {
    "email": ("email", "e-mail", "mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
}
AGAINST = re.compile(r"(?:[$€£%#=]|version|isbn|issn|no\.|nr\.|https?://\S*)\s*$", re.IGNORECASE)
_WORD = re.compile(r"\w+")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outward in linear time."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            found.append((start, free))
        at = text.find("@", free)
    return found


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns that pass their tests, by start, then kind."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def more_candidates(text: str, base: list[Span]) -> list[Span]:
    """Candidates that touch no base span."""
    spans = [("email", *m.span()) for m in SPELLED.finditer(text)]
    spans += [("phone", *m.span()) for m in LOCAL_NUMBER.finditer(text)]
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    out = []
    for kind, a, b in spans:
        i = int(np.searchsorted(starts, b))
        if not any(x < b and a < y for x, y in taken[max(0, i - 2) : i]):
            out.append((kind, a, b))
    return out


def votes(text: str, span: Span, is_base: bool) -> str:
    """One letter per labeler: p (personal), n (not), or - (no vote)."""
    kind, a, b = span
    inside, before, after = text[a:b], text[max(0, a - 40) : a], text[b : b + 10]
    digits = _digits(inside)
    cue = {w.lower() for w in _WORD.findall(before)[-4:]}
    form = "p" if is_base else "-"
    if kind == "phone" and not is_base:
        groups = re.findall("[0-9]+", inside)
        form = "p" if 9 <= len(digits) <= 12 and [len(g) for g in groups][-2:] == [3, 4] else "n"
    checks = {
        "email": "p" if re.search(r"\.[A-Za-z]{2,}$", inside) else "n",
        "ip": "p" if len(set(digits)) > 1 else "n",
        "card": "p" if len(digits) in (14, 15, 16) else "-",
        "phone": "p" if 10 <= len(digits) <= 13 else "n",
    }[kind]
    return "".join(
        [
            form,
            "p" if cue.intersection(CUES[kind]) else "-",
            "n" if AGAINST.search(before) else "-",
            checks,
            "n" if len(set(digits)) == 1 and digits else "-",
            "n" if before[-1:].isalnum() or after[:1].isalnum() else "p",
        ]
    )


def features(text: str, span: Span) -> list[int]:
    """Hashed features: the span's shape in trigrams, and the words around it."""
    kind, a, b = span
    shape = re.sub("[a-z]+", "a", re.sub("[A-Z]+", "A", re.sub("[0-9]", "9", text[a : min(b, a + 80)])))
    named = [kind, f"{kind}|{b - a >> 2}"]
    named += [f"{kind}~{shape[i : i + 3]}" for i in range(max(1, len(shape) - 2))]
    named += [f"{kind}<{w.lower()}" for w in _WORD.findall(text[max(0, a - 40) : a])[-3:]]
    named += [f"{kind}>{w.lower()}" for w in _WORD.findall(text[b : b + 40])[:2]]
    return sorted({zlib.crc32(n.encode("utf-8", "replace")) % FEATURES for n in named})


def _found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for text in frame["text"]:
            base = base_spans(text)
            spans = [(s, True) for s in base] + [(s, False) for s in more_candidates(text, base)]
            rows.append(
                [
                    {"kind": s[0], "a": s[1], "b": s[2], "base": is_base,
                     "votes": votes(text, s, is_base), "features": features(text, s)}
                    for s, is_base in spans
                ]
            )
        yield pd.DataFrame({"id": frame["id"], "spans": rows})


def reliabilities(patterns: list[tuple[str, int]]) -> dict[str, float]:
    """Posterior of each vote pattern, by expectation-maximisation over pattern counts.

    Two hidden classes; each labeler has its own chances of p, n and no vote in either class.
    """
    names = [p for p, _ in patterns]
    n = np.array([c for _, c in patterns], float)
    vote = np.array([["pn-".index(v) for v in p] for p in names])
    # start from the majority of the votes
    lead = (vote == 0).sum(1) - (vote == 1).sum(1)
    post = 1 / (1 + np.exp(-2.0 * lead))
    for _ in range(STEPS):
        log = np.zeros((len(names), 2))
        for k, weight in enumerate((post * n, (1 - post) * n)):
            log[:, k] = np.log((weight.sum() + 1) / (n.sum() + 2))
            for j in range(vote.shape[1]):
                count = np.bincount(vote[:, j], weight, 3) + 1
                log[:, k] += np.log(count / count.sum())[vote[:, j]]
        post = 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -500, 500)))
    return dict(zip(names, post.tolist(), strict=True))


def fit_classifier(rows: list[tuple[list[int], float]]) -> np.ndarray:
    """Logistic regression on sparse features with probabilistic labels; the last weight is the bias."""
    weights, speed = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-6)
    columns = [np.array([*f, FEATURES]) for f, _ in rows]
    labels = np.array([y for _, y in rows])
    if not len(rows):
        weights[FEATURES] = -10.0
        return weights
    flat = np.concatenate(columns)
    row = np.repeat(np.arange(len(rows)), [len(c) for c in columns])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[flat], len(rows)), -30, 30)))
        slope = np.bincount(flat, (p - labels)[row], FEATURES + 1) / len(rows) + 1e-5 * weights
        speed += slope**2
        weights -= 0.5 * slope / np.sqrt(speed)
    return weights


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and base_sha256 are of the base spans; ``spans`` holds those and the added ones.
    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind, joined by
    commas.  NULL text counts as empty.  Repeated rows get the same result each, an empty table
    gives no rows, other columns are not read.  Texts are read whole and once.
    """
    # ids travel as strings: pandas has no whole numbers with NULL among them
    base = docs.select(
        F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    span = "kind string, a long, b long, base boolean, votes string, features array<int>"
    kind_of = f"array<struct<{', '.join(f'{x.split()[0]}: {x.split()[1]}' for x in span.split(', '))}>>"
    found = stored(base.mapInPandas(_found, f"id string, spans {kind_of}"))
    each = found.select("id", F.explode("spans").alias("s")).select("id", "s.*")
    # at most 3 ** 6 patterns, whatever the number of candidates
    patterns = each.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    post = reliabilities([(r["votes"], r["n"]) for r in patterns]) if patterns else {}
    draw = F.xxhash64("id", "kind", "a", "features")
    share = min(1.0, SAMPLE / max(1, sum(r["n"] for r in patterns)))
    sample = each.filter(F.pmod(draw, F.lit(1 << 31)) < F.lit(share * (1 << 31)))
    sample = sorted(sample.select("features", "votes").collect())  # in one order, so reruns agree
    weights = fit_classifier([(r["features"], post[r["votes"]]) for r in sample])
    shared = docs.sparkSession.sparkContext.broadcast((weights, post))

    def judged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, posterior = shared.value
        for frame in frames:
            rows = []
            for spans in frame["spans"]:
                kept, base_only = [], []
                for s in spans:
                    one = (s["a"], KINDS.index(s["kind"]), s["b"])
                    if s["base"]:
                        base_only.append(one)
                        kept.append(one)
                        continue
                    p = 1 / (1 + np.exp(-(w[s["features"]].sum() + w[FEATURES])))
                    if min(p, posterior[s["votes"]]) >= ADD_FROM:
                        kept.append(one)
                joined = [
                    ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(x)) for x in (base_only, kept)
                ]
                counts = [sum(k == i for _, k, _ in base_only) for i in range(len(KINDS))]
                sha = hashlib.sha256(joined[0].encode()).hexdigest()
                rows.append((*counts, sha, joined[1], len(kept) - len(base_only)))
            names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", frame["id"])
            yield out

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return found.mapInPandas(
        judged, f"doc_id string, {counts}, base_sha256 string, spans string, n_added long"
    ).withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
