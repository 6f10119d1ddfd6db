import random

import pytest
from pyspark.sql import functions as F, types as T

CLASHING = ("row", "key", "size", "block", "kept", "lines", "node", "id", "n", "shard", "h", "words", "t", "copy",
            "bucket", "text_a", "covered", "full", "draw", "lang_pred", "kept_text", "place", "w")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def table(spark):
    """Function: rows of (doc_id, text, lang, source) to a table with extra columns of clashing names."""

    def build(rows, extra=CLASHING):
        df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
        return df.withColumns({c: F.lit(f"other {c}") for c in extra})

    return build


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(rng, n, words=("the", "of", "and", "sea", "land", "river", "stone", "cloud", "light", "tree")):
    return " ".join(rng.choice(words) + rng.choice(["", "s", "er", "ing", str(rng.randint(0, 99))]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """NULLs in every column, empty and very long texts, ties, repeated rows, odd white space."""
    rng = random.Random(3)
    long = "\n".join(prose(rng, 12) for _ in range(3000))
    shared = prose(rng, 60)
    rows = [
        (None, None, None, None),
        (None, "", "en", "a"),
        (None, shared, None, "b"),
        (1, None, "en", None),
        (2, "", None, "a"),
        (3, " \t\n\x0b\x0c\r ", "en", "a"),
        (4, shared, "en", "a"),
        (4, shared, "en", "a"),
        (4, prose(rng, 30), "fr", "a"),
        (5, shared.upper(), "en", "b"),
        (6, prose(rng, 20) + "\n" + shared + "\n" + prose(rng, 20), "en", "b"),
        (7, long, "en", "c"),
        (8, long + " end", "en", "c"),
        (9, "x" * 5000, "en", "c"),
        (10, "one two", "en", "Ω"),
        (11, "ONE two", "en", "Ω"),
        (12, "one two", "en", ""),
        (13, "é€𝔘 naïve ▁ <s> \x00 tail", "fr", ""),
        (2**53 + 1, prose(rng, 40), "en", "a"),
        (-5, prose(rng, 40), "en", "a"),
    ]
    return rows + [(100 + i, prose(rng, rng.randint(1, 80)), rng.choice(["en", "fr"]), rng.choice("abc")) for i in range(20)]
