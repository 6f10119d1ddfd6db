"""Word shingles as sorted 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
KEPT_WORDS = 300_000  # hashes of words that a task remembers at a time

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # splitmix64's constants


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sets of distinct word shingles.  A-Z count as a-z; words part at ASCII white space."""

    def __init__(self, words: int = WORDS) -> None:
        self.words = words
        rng = np.random.Generator(np.random.PCG64(7))
        self.factors = rng.integers(0, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; a text with fewer words than a shingle has one for all."""
        parts = (text or "").encode("utf-8", "replace").lower().split()
        if not parts:
            return np.empty(0, np.uint64)
        if len(parts) < self.words:
            whole = xxhash.xxh3_64_intdigest(b" ".join(parts), seed=len(parts))
            return np.array([whole], np.uint64)
        known, digest = self.known, xxhash.xxh3_64_intdigest
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(parts).difference(known):
            known[w] = digest(w)
        h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
        n = len(h) - self.words + 1
        total = h[:n] * self.factors[0]
        for i in range(1, self.words):
            total += h[i : i + n] * self.factors[i]
        return np.unique(mixed(total))
