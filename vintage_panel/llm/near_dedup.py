"""Near-duplicates by min-max hashing.

Each permutation of the shingle hashes yields two signature values, its minimum and its
maximum, so the evaluations are half of the signature's length.  Bands of four values bring
candidates together; every link is confirmed on the full sets.

No bucket is expanded into all pairs.  Equal sets are one node.  First every node of a
bucket is compared with one node of the bucket, and again with another one where its
component still differs; what links forms components.  Nodes of
buckets that still hold several components then go through an exact join on their rarest
shingles, which names the pairs across components that can link at all.  So no link that
joins components is lost, while a group of many copies costs one comparison per copy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import SPACES, stored
from .components import connected_components
from .line_dedup import document_key
from .shingles import Shingler, mixed

PERMUTATIONS = 72
BAND = 4  # values; with 36 bands a pair at 0.75 is missed about once in a million
PERCENT = 75
STARS = 3  # rounds in which all nodes of a bucket meet one of them
BLOCK = 2048  # shingles that a task permutes at a time


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(11))
    odd = rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], rng.integers(0, 2**32, n, dtype=np.uint32)[:, None]


def min_max(h: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Signature of a non-empty set: minimum and maximum under each permutation, in turn."""
    short = (h >> np.uint64(32)).astype(np.uint32)[None, :]
    low = np.full(len(odd), 2**32 - 1, np.uint32)
    high = np.zeros(len(odd), np.uint32)
    for i in range(0, short.shape[1], BLOCK):
        permuted = short[:, i : i + BLOCK] * odd + add
        np.minimum(low, permuted.min(axis=1), out=low)
        np.maximum(high, permuted.max(axis=1), out=high)
    return np.stack([low, high], axis=1).ravel()


def band_keys(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    rows = signature.astype(np.uint64).reshape(-1, band)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for column in rows.T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def _signatures(permutations: int, band: int):
    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, (odd, add) = Shingler(), _permutations(permutations)
        for frame in frames:
            n, nodes, bands = [], [], []
            for text in frame["text"]:
                h = shingles(text)
                n.append(len(h))
                nodes.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                bands.append(band_keys(min_max(h, odd, add), band).view(np.int64) if len(h) else None)
            yield pd.DataFrame({"key": frame["key"], "n": n, "node": nodes, "bands": bands})

    return mapped


def _confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingles = Shingler()
    last: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.uint64))
    for frame in frames:
        linked = []
        for b, text_a, text_b in zip(frame["b"], frame["text_a"], frame["text_b"], strict=True):
            if last[0] != b:
                last = (b, shingles(text_b))
            one, two = shingles(text_a), last[1]
            both = len(np.intersect1d(one, two, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(one) + len(two) - both))
        yield frame.loc[linked, ["a", "b"]]


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) of nodes, those whose full sets are similar enough."""
    n_a = texts.select(F.col("node").alias("a"), F.col("n").alias("n_a"))
    n_b = texts.select(F.col("node").alias("b"), F.col("n").alias("n_b"))
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    pairs = pairs.join(n_a, "a").join(n_b, "b").filter(near).select("a", "b")
    return (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .mapInPandas(_confirm, "a binary, b binary")
    )


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingles = Shingler()
    for frame in frames:
        yield pd.DataFrame(
            {"node": frame["node"], "root": frame["root"], "n": frame["n"],
             "tokens": [shingles(t).view(np.int64) for t in frame["text"]]}
        )


def _size_class(n: str) -> Column:
    return F.floor(F.log(F.expr(n).cast("double")) / math.log(1.05)).cast("int")


def _pairs_across(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, root) with different roots that may link; none that does is missed.

    An exact set-similarity join.  Each set is ordered from its rarest shingle on.  Of two
    linked sets the smaller one's first seventh and the larger one's first quarter share a
    shingle, and behind their first common one both are long enough.  Shingles that all stand
    in one component are left out, and nodes of a shingle's main component meet the others only.
    """
    whole = texts.join(nodes, "node").select("node", "root", "n", "text")
    tokens = stored(
        whole.mapInPandas(_sets, "node binary, root binary, n long, tokens array<bigint>")
        .select("node", "root", "n", F.explode("tokens").alias("token"))
    )
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    ranked = (
        tokens.join(often, "token")
        .groupBy("node", "root", "n")
        .agg(F.array_sort(F.collect_list(F.struct("f", "token"))).alias("common"))
        # shingles of this set alone come first
        .withColumn("alone", F.col("n") - F.size("common"))
        .withColumn("probe", F.expr(f"n - ({PERCENT} * n + 99) div 100 + 1"))
        .withColumn("index", F.expr(f"n - (2 * {PERCENT} * n + {99 + PERCENT}) div {100 + PERCENT} + 1"))
        .filter("probe > alone")
        .select("node", "root", "n", "index", "alone", F.posexplode(F.expr("slice(common, 1, int(probe - alone))")))
        .select("node", "root", "n", "index", (F.col("alone") + F.col("pos") + 1).alias("at"), "col.token")
    )
    entries = stored(ranked)
    main = (
        entries.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m"))
        .groupBy("token").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
        .filter("roots > 1")
        .select("token", "main")
    )
    entries = stored(entries.join(main, "token").withColumn("other", F.col("root") != F.col("main")).drop("main"))
    smaller = entries.filter("at <= index").select(
        "token", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"),
        F.col("at").alias("at_b"), F.col("other").alias("other_b"), _size_class("n").alias("class"),
    )
    # partners of a larger set: from 75 % of its size to what is left behind this shingle
    most = F.expr(f"least(n, ({100 + PERCENT} * (n - at + 1)) div {PERCENT} - n)")
    larger = (
        entries.withColumn("most", most)
        .withColumn("fewest", F.expr(f"({PERCENT} * n + 99) div 100"))
        .filter("most >= fewest and fewest > 0")
        .select(
            "token", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_a"),
            F.col("at").alias("at_a"), F.col("other").alias("other_a"),
            F.explode(F.sequence(_size_class("fewest"), _size_class("most"))).alias("class"),
        )
    )
    fits = F.expr(
        "root_a <> root_b and n_b <= n_a and "
        f"{100 + PERCENT} * (1 + least(n_a - at_a, n_b - at_b)) >= {PERCENT} * (n_a + n_b)"
    )
    met = larger.join(smaller.filter("other_b"), ["token", "class"]).filter(fits).select("a", "b").union(
        larger.filter("other_a").join(smaller.filter("not other_b"), ["token", "class"]).filter(fits).select("a", "b")
    )
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    permutations: int = PERMUTATIONS, band: int = BAND,
) -> DataFrame:
    """Per row of ``docs``: key (id and text hash), doc_id, n_shingles, component_id, leader.

    A set holds the distinct 5-word shingles of the whole text, or with fewer words the whole
    sequence as one; shingles are compared by 64-bit hashes.  Rows link where 100 times the
    common part is at least 75 times the union.  component_id is the smallest id reachable.
    ``leader``: the row has the smallest key of its component.  Empty sets link with nothing
    and lead themselves.  NULL ids sort first as keys but are passed over by component_id
    unless there is no other.  An empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType
    key_type = T.StructType([T.StructField("id", id_type), T.StructField("h", T.LongType())])
    packed = docs.select(
        document_key(id_col, text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    plain = packed.select(F.to_json("key").alias("key"), "text")
    rows = stored(
        plain.mapInPandas(
            _signatures(permutations, band), "key string, n long, node binary, bands array<bigint>"
        ).withColumn("key", F.from_json("key", key_type))
    )
    nodes = (
        rows.filter("n > 0")
        .groupBy("node")
        .agg(F.min("key").alias("key"), F.max("n").alias("n"), F.max("bands").alias("bands"))
    )
    entries = stored(nodes.select("node", F.explode("bands").alias("bucket")))
    several = (
        entries.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x <> y")
    )
    buckets = stored(entries.join(several.select("bucket"), "bucket"))  # of two nodes or more
    shared = buckets.select("node").distinct()
    chosen = (
        rows.filter("n > 0").groupBy("node").agg(F.min("key").alias("key"), F.max("n").alias("n"))
        .join(shared, "node")
    )
    texts = stored(packed.join(chosen, "key").dropDuplicates(["key"]).select("node", "n", "text"))

    links, placed = None, buckets.select("bucket", "node", F.col("node").alias("root"))
    for turn in range(STARS):
        # one node per bucket: first the smallest, then one by a hash that differs by bucket
        by = F.xxhash64("node", "bucket", F.lit(turn)) if turn else F.col("node")
        hubs = (
            placed.groupBy("bucket")
            .agg(
                F.min_by(F.struct("node", "root"), by).alias("hub"),
                F.min("root").alias("x"),
                F.max("root").alias("y"),
            )
            .filter("x <> y")
            .select("bucket", "hub")
        )
        stars = (
            placed.join(hubs, "bucket").filter("root <> hub.root")
            .select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct()
        )
        found = _links(stars, texts)
        links = stored(found if links is None else links.union(found))
        roots = connected_components(links)
        placed = stored(
            buckets.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
        )
    mixed_buckets = (
        placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    )
    open_nodes = stored(placed.join(mixed_buckets.select("bucket"), "bucket").select("node", "root").distinct())
    more = stored(_links(_pairs_across(open_nodes, texts), texts))
    if not more.isEmpty():
        roots = connected_components(links.union(more))
    roots = stored(roots)

    labelled = (
        rows.select("key", "n", "node")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = labelled.filter("n > 0").groupBy("root").agg(
        F.min("key.id").alias("smallest"), F.min("key").alias("first")
    )
    return labelled.join(named, "root", "left").select(
        "key",
        F.col("key.id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("key.id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("key") == F.col("first"))).alias("leader"),
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest key stays.

    Rows without words stay.  Of rows that repeat an id and a text one stays.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    wordless = F.length(F.translate(text, SPACES, "")) == 0
    leaders = (
        near_groups(docs.filter(~wordless), id_col, text_col).filter("leader").select("key").distinct()
    )
    packed = docs.filter(~wordless).select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), document_key(id_col, text_col).alias("key")
    )
    one = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    kept = packed.join(leaders, "key").withColumn("one", one).filter("one = 1").select("row.*")
    return kept.union(docs.filter(wordless))
