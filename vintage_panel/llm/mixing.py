"""Mixing sources to target weights, with DataFrame and SQL functions alone.

Each source's documents are dealt into blocks by a hash.  A target becomes an exact number of
block copies of the source (its quota).  A splitting tree then divides the quotas among output
shards: at each node the left half of the slots takes a multivariate hypergeometric draw of
what the node holds, the right half the rest.  A shard draws its share of each source's
permuted blocks, disjoint from all other shards, and is shuffled for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import partitions, stored, words

SEED = "mix"
BLOCK_WORDS = 1_000_000  # a source has 256 blocks and one more for each of so many words
SHARD_WORDS = 4_000_000  # words of a shard, about


def _hash(*parts: Column) -> Column:
    """52 bits of an md5 over the parts, as a long; NULL counts as empty."""
    text = F.concat_ws("|", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def source_targets(
    by_source: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    cap: int = 2,
) -> DataFrame:
    """``by_source`` (source, source_size), one row per source, with its target.

    Sources by code point, NULL last, take the weights in turn and share ``share`` (a
    fraction) of all sizes.  A target stops at ``cap`` times the source's size and the excess
    goes to the others by weight, until none is above.
    """
    top, bottom = share
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("place", F.row_number().over(named)).withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(w) for w in weights]),
            ((F.col("place") - 1) % len(weights) + 1).cast("int"),
        ).cast("long"),
    )
    every = Window.partitionBy()
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    # the level per weight if this source and all after it were below their cap
    level = (
        ranked.withColumn("total", F.sum("source_size").over(every))
        .withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap)
        .withColumn(
            "rest",
            F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        )
        .withColumn("num", F.col("total") * top - F.col("full") * bottom)
        .withColumn("den", F.col("rest") * bottom)
        .withColumn("capped", F.col("source_size") * cap * F.col("den") <= F.col("weight") * F.col("num"))
        .withColumn("step", F.row_number().over(filling))
    )
    found = level.withColumn(
        "at", F.min(F.when(~F.col("capped"), F.struct("step", "num", "den"))).over(every)
    )
    return found.select(
        "source",
        "source_size",
        F.when(F.col("capped"), (F.col("source_size") * cap).cast("double"))
        .otherwise((F.col("weight") * F.col("at.num")).cast("double") / F.col("at.den"))
        .alias("target"),
    )


def _block(targets_size: Column, doc_id: Column) -> Column:
    blocks = F.lit(256) + F.ceil(targets_size / F.lit(BLOCK_WORDS))
    return F.pmod(_hash(doc_id), blocks.cast("long"))


def _draw(total: str, held: str, slots: str, chance: str) -> str:
    """SQL for a hypergeometric draw: of ``slots`` out of ``total``, how many fall on ``held``.

    Walks outward from the mode with the ratio of neighbouring probabilities: once to add
    them up, once more to the point that ``chance`` (0 to 1) names.
    """
    lo = "greatest(0L, d.slots - (d.total - d.held))"
    hi = "least(d.held, d.slots)"
    up = "(d.held - x) * double(d.slots - x) / ((x + 1) * double(d.total - d.held - d.slots + x + 1))"
    down = "x * double(d.total - d.held - d.slots + x) / ((d.held - x + 1) * double(d.slots - x + 1))"
    upward = "if(d.mode < d.hi, sequence(d.mode, d.hi - 1), array())"
    downward = "if(d.mode > d.lo, sequence(d.mode, d.lo + 1, -1L), array())"
    weigh = (
        "aggregate({walk}, named_struct('w', 1.0D, 'sum', 0.0D), (a, x) -> "
        "named_struct('w', a.w * {ratio}, 'sum', a.sum + a.w * {ratio}), a -> a.sum)"
    )
    both = (
        f"1.0D + {weigh.format(walk=upward, ratio=up)} + {weigh.format(walk=downward, ratio=down)}"
    )
    pick = (
        "aggregate({walk}, {start}, (a, x) -> if(a.at >= 0, a, named_struct("
        "'w', a.w * {ratio}, 'left', a.left - a.w * {ratio}, "
        "'at', if(a.left - a.w * {ratio} <= 0, x + {step}, -1L))))"
    )
    first = pick.format(
        walk=upward,
        ratio=up,
        step="1L",
        start="named_struct('w', 1.0D, 'left', d.goal - 1.0D, 'at', if(d.goal <= 1.0D, d.mode, -1L))",
    )
    second = pick.format(
        walk=downward,
        ratio=down,
        step="-1L",
        start="named_struct('w', 1.0D, 'left', f.left, 'at', f.at)",
    )

    def let(name: str, value: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    given = f"named_struct('total', {total}, 'held', {held}, 'slots', {slots}, 'u', {chance})"
    ends = f"named_struct('total', d.total, 'held', d.held, 'slots', d.slots, 'u', d.u, 'lo', {lo}, 'hi', {hi})"
    mode = (
        "named_struct('total', d.total, 'held', d.held, 'slots', d.slots, 'u', d.u, 'lo', d.lo, "
        "'hi', d.hi, 'mode', least(d.hi, greatest(d.lo, "
        "bigint(floor(double(d.slots + 1) * (d.held + 1) / (d.total + 2))))))"
    )
    goal = (
        "named_struct('total', d.total, 'held', d.held, 'slots', d.slots, 'lo', d.lo, "
        f"'hi', d.hi, 'mode', d.mode, 'goal', d.u * ({both}))"
    )
    # rounding may leave a rest: then the last point of the walk
    chosen = let("f", first, let("g", second, "if(g.at >= 0, g.at, d.lo)"))
    return let("d", given, let("d", ends, let("d", mode, let("d", goal, chosen))))


def split_quotas(quotas: DataFrame, depth: int) -> DataFrame:
    """Splitting tree over ``quotas`` (source, quota): rows (shard, source, first, upto).

    A shard takes the copies ``first`` (incl.) to ``upto`` (excl.) of each source.  All
    shards hold equally many copies, give or take one, and a source's shares add up to its
    quota.  The draws depend on the seed, the node and the source alone.
    """
    held = F.sort_array(F.collect_list(F.struct("source", "quota", F.lit(0).cast("long").alias("first"))))
    nodes = quotas.agg(held.alias("held")).select(F.lit(0).cast("long").alias("shard"), "held")
    draw = _draw(
        "a.total",
        "s.quota",
        "a.slots",
        "(conv(substring(md5(concat_ws('|', '" + SEED + "', level, shard, s.source)), 1, 13), 16, 10) + 0.5D) / 4503599627370496.0D",
    )
    drawn = (
        "aggregate(held, named_struct('total', aggregate(held, 0L, (n, s) -> n + s.quota), "
        "'slots', bigint(floor(aggregate(held, 0L, (n, s) -> n + s.quota) / 2)), "
        "'took', cast(array() as array<bigint>)), (a, s) -> "
        f"transform(array({draw}), x -> named_struct('total', a.total - s.quota, "
        "'slots', a.slots - x, 'took', array_append(a.took, x)))[0], a -> a.took)"
    )
    left = "transform(held, (s, i) -> named_struct('source', s.source, 'quota', took[i], 'first', s.first))"
    right = (
        "transform(held, (s, i) -> named_struct('source', s.source, 'quota', s.quota - took[i], "
        "'first', s.first + took[i]))"
    )
    for level in range(depth):
        nodes = (
            nodes.withColumn("level", F.lit(level))
            .withColumn("took", F.expr(drawn))
            .select(
                F.explode(
                    F.expr(
                        f"array(named_struct('shard', shard * 2, 'held', {left}), "
                        f"named_struct('shard', shard * 2 + 1, 'held', {right}))"
                    )
                ).alias("node")
            )
            .select("node.*")
        )
    return nodes.select("shard", F.explode("held").alias("s")).select(
        "shard",
        F.col("s.source").alias("source"),
        F.col("s.first").alias("first"),
        (F.col("s.first") + F.col("s.quota")).alias("upto"),
    )


def source_key() -> Column:
    """The source as a key that is never NULL."""
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))


def numbered_copies(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """Copies of blocks that meet the targets: source_key, block, copy, number.

    ``blocks`` has source_key, block, block_size.  Whole passes over a source come first, then
    the permuted blocks whose words come nearest to the rest of the target.
    """
    by_source = Window.partitionBy("source_key")
    order = by_source.orderBy(_hash(F.col("source_key"), F.col("block")), "block")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    middle = F.sum("block_size").over(running) * 2 - F.col("block_size")
    ranked = (
        blocks.join(targets.select("source_key", "source_size", "target"), "source_key")
        .withColumn("rank", F.row_number().over(order).cast("long") - 1)
        .withColumn("middle", middle)
        .withColumn("n_blocks", F.count(F.lit(1)).over(by_source))
        .withColumn("passes", F.coalesce(passes, F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("part", ((F.col("rest") > 0) & (F.col("middle") <= F.col("rest") * 2)).cast("long"))
    )
    times = F.expr("if(passes + part > 0, sequence(0L, passes + part - 1), cast(array() as array<bigint>))")
    return ranked.withColumn("copy", F.explode(times)).select(
        "source_key", "block", "copy", (F.col("copy") * F.col("n_blocks") + F.col("rank")).alias("number")
    )


def dealt(numbered: DataFrame, depth: int) -> DataFrame:
    """``numbered`` with the shard that takes each copy, by the splitting tree."""
    quotas = numbered.groupBy(F.col("source_key").alias("source")).agg(F.count(F.lit(1)).alias("quota"))
    split = split_quotas(quotas, depth).filter("upto > first")
    # a copy lies in one range of its source; copies and ranges meet in bins of 64 numbers
    ranges = split.withColumnRenamed("source", "source_key").withColumn(
        "bin", F.explode(F.expr("sequence(first div 64, (upto - 1) div 64)"))
    )
    return (
        numbered.withColumn("bin", F.expr("number div 64"))
        .join(ranges, ["source_key", "bin"])
        .filter("number >= first and number < upto")
        .select("source_key", "block", "copy", "shard")
    )


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    cap: int = 2,
    shard_words: int = SHARD_WORDS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, targets, copies): sizes of all documents, targets of sources, copies with shards.

    NULL is a source of its own, a NULL text has no words, a NULL id hashes as empty; rows
    that repeat an id and source share their block.  An empty table gives three empty ones.
    All three are stored, so Spark knows their sizes when it chooses joins.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.size(words(F.col(text_col))).cast("long").alias("size"),
        )
    )
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(by_source, weights, share, cap).withColumn("source_key", source_key()))
    taken = targets.agg(F.sum("target")).first()[0] or 0.0
    depth = max(1, int(taken / shard_words).bit_length())
    blocks = in_blocks(rows, targets).groupBy("source_key", "block").agg(F.sum("size").alias("block_size"))
    copies = stored(dealt(numbered_copies(blocks, targets), depth))
    return rows, targets, copies


def in_blocks(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``rows`` (with doc_id, source) with source_key, source_size, target and block."""
    known = targets.select("source_key", "source_size", "target")
    return (
        rows.withColumn("source_key", source_key())
        .join(known, "source_key")
        .withColumn("block", _block(F.col("source_size"), F.col("doc_id")))
    )


def mixed_sizes(docs: DataFrame, **plan) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, taken (words)."""
    rows, targets, copies = plan_mix(docs, **plan)
    times = copies.groupBy("source_key", "block").agg(F.count(F.lit(1)).alias("times"))
    return (
        in_blocks(rows, targets)
        .join(times, ["source_key", "block"], "left")
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"),
        )
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **plan) -> DataFrame:
    """The mix itself: ``docs`` repeated as often as they are taken, shard by shard.

    Columns of ``docs`` in one struct ``row``, then ``shard`` and ``copy``.  Each shard is
    shuffled locally by a hash; a rerun gives the same shards and order.
    """
    _, targets, copies = plan_mix(docs, id_col=id_col, source_col=source_col, **plan)
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
    )
    place = _hash(F.col("doc_id"), F.col("copy"), F.lit("order"))
    return (
        in_blocks(packed, targets)
        .join(copies, ["source_key", "block"])
        .select("row", "shard", "copy", place.alias("place"))
        .repartition(partitions(docs.sparkSession), "shard")
        .sortWithinPartitions("shard", "place")
        .select("row", "shard", "copy")
    )
