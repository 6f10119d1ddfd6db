"""Repeated passages of lines, found by overlapping windows of three lines.

The lines of a document that hold a word are hashed in threes, every window with the next
overlapping by two.  A window is a repeat when the same three lines stand earlier: in a
document with a smaller key, or further up in the same one.  All lines that a repeat covers
go; lines between that hold no word stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

LINES = 3


def document_key(id_col: str, text_col: str) -> Column:
    """Orders documents by id, and tells apart rows that share an id but not the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = LINES) -> DataFrame:
    """One row per window: key, at (place of its first line among the lines with a word), hash.

    Lines are compared without carriage returns and without spaces at their ends.  The hash
    is an md5 over all of a window's lines, so unequal windows do not meet.
    """
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("\r"), F.lit(""))
    lines = F.transform(F.filter(F.split(text, "\n", -1), has_word), lambda x: F.trim(x))

    def windows(x: Column) -> Column:
        starts = F.when(F.size(x) >= k, F.sequence(F.lit(0), F.size(x) - k)).otherwise(
            F.array().cast("array<int>")
        )
        hashed = lambda p: F.unhex(F.md5(F.array_join(F.slice(x, p + 1, k), "\n")))
        return F.transform(starts, lambda p: F.struct(p.alias("at"), hashed(p).alias("hash")))

    # the lines are bound to a name, or else they would be made anew for every window
    bound = F.element_at(F.transform(F.array(lines), windows), 1)
    return (
        docs.select(document_key(id_col, text_col).alias("key"), F.explode(bound).alias("w"))
        .select("key", "w.at", "w.hash")
    )


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = LINES) -> DataFrame:
    """Per document with repeats: key, covered (sorted places of the lines that go)."""
    windows = line_windows(docs, id_col, text_col, k)
    # combined before the shuffle: a window that half of all documents hold is one row a task
    first = (
        windows.groupBy("hash")
        .agg(F.min(F.struct("key", "at")).alias("first"), F.max(F.struct("key", "at")).alias("last"))
        .filter(F.col("first") < F.col("last"))
        .select(F.col("hash"), "first")
    )
    # the join's left side may be hot on a hash; Spark splits such partitions at run time
    later = windows.join(stored(first), "hash").filter(F.struct("key", "at") > F.col("first"))
    return (
        later.groupBy("key")
        .agg(F.collect_set("at").alias("starts"))
        .select(
            "key",
            F.array_sort(
                F.array_distinct(
                    F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (k - 1))))
                )
            ).alias("covered"),
        )
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = LINES) -> DataFrame:
    """``docs`` with ``row`` (all its columns in a struct), kept_text, n_lines, n_removed.

    n_lines and n_removed count lines that hold a word.  A text with fewer than ``k`` such
    lines has no window and stays as it is.  A NULL text stays NULL, a text of which all lines
    go becomes empty.  Documents rank by id (NULL first); rows that repeat an id and a text
    are one document and are treated alike.  An empty table gives no rows.
    """
    covered = repeated_lines(docs, id_col, text_col, k)
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col(text_col).alias("t"),
        document_key(id_col, text_col).alias("key"),
    )
    joined = packed.join(covered, "key", "left")  # keys are structs: NULL ids in them meet

    def counted(x: Column) -> Column:
        """Number of lines with a word, and the text without the covered ones."""
        numbered = F.filter(
            F.transform(x, lambda line, i: F.struct(line.alias("line"), i.alias("i"))),
            lambda l: has_word(l["line"]),
        )

        def kept(full: Column) -> Column:
            gone = F.transform("covered", lambda p: F.get(full, p)["i"])
            left = F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone)
            text = F.array_join(F.transform(left, lambda i: F.get(x, i)), "\n")
            return F.struct(F.size(full).alias("n"), F.when(F.col("covered").isNotNull(), text).alias("text"))

        return F.element_at(F.transform(F.array(numbered), kept), 1)

    # names are bound by transform() over one element, so that nothing is made twice
    found = F.element_at(F.transform(F.array(F.split("t", "\n", -1)), counted), 1)
    return joined.withColumn("found", F.when(F.col("t").isNotNull(), found)).select(
        "row",
        F.when(F.col("covered").isNull(), F.col("t")).otherwise(F.col("found.text")).alias("kept_text"),
        F.coalesce("found.n", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )
