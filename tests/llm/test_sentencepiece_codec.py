import random
from pathlib import Path

import pytest
import sentencepiece

from vintage_panel.llm.sentencepiece_codec import (
    START, Pieces, decode, encode, end_state, packed, path, product, read_model, transfer, unpacked,
)
from vintage_panel.llm.settings import PIECES

pytestmark = pytest.mark.skipif(not Path(PIECES).exists(), reason="no vocabulary file")


@pytest.fixture(scope="module")
def model():
    return read_model(PIECES)


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def texts(rng):
    syllables = ["the ", "ing", "tion", " ", "é", "日本", "12", "\n", "==", "a", "  ", "▁", "un", "ver"]
    for _ in range(120):
        yield "".join(rng.choice(syllables) for _ in range(rng.randint(60, 260)))
        yield "".join(rng.choice("aeinrst") for _ in range(rng.randint(130, 400)))
        yield " " * rng.randint(100, 200) + rng.choice("ab") + " " * rng.randint(0, 99)


def test_chunks_give_the_whole_encoding(model, library):
    p, rng = Pieces(model), random.Random(1)
    for text in texts(rng):
        t, chunk = p.normal(text), rng.choice([64, 71, 100])
        n = max(1, len(t) // chunk)
        cuts = [*(i * chunk for i in range(n)), len(t)]
        ms = [
            transfer(p, t[max(0, a - p.longest) : a], t[a:b], t[b : b + p.longest], i == 0, i == n - 1)
            for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
        ]
        assert [unpacked(packed(m)) for m in ms] == ms
        states = path(ms, START, end_state(ms))
        ids = [i for a, b, s, e in zip(cuts, cuts[1:], states, states[1:], strict=False) for i in p.encode(t[a + s[1] : b + e[1]])]
        assert ids == library.encode(text)
        assert p.decode(ids) == text.replace("▁", " ")
        if len(ms) > 2:  # the product is associative
            assert product(product(ms[0], ms[1]), ms[2]) == product(ms[0], product(ms[1], ms[2]))


def test_tables_equal_the_library(table, edge_rows, model, library):
    rng = random.Random(2)
    rows = [*edge_rows, *((500 + i, t, "en", "a") for i, t in enumerate(list(texts(rng))[:60]))]
    for chunk in (64, 32_768):
        encoded = encode(table(rows), model, chunk=chunk)
        got = decode(encoded, model).select("row.text", "ids", "decoded", "round_trip").collect()
        assert len(got) == len(rows)
        for text, ids, decoded, same in got:
            assert same
            assert ids == library.encode(text or "")
            assert decoded == (text or "").replace("▁", " ")


def test_empty(empty, model):
    assert encode(empty, model).collect() == []
