"""Connected components by alternating large and small stars, each step a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): the smallest node of each component.

    Each step points neighbours at the smallest node around; minima are combined before the
    shuffle, and the edges of a hot node are split by Spark's skew join.  The number of steps
    grows as the logarithm of the largest component.  Every step is stored, so a lost
    executor costs one step.
    """
    edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    seen = None
    while True:
        # large star: larger neighbours of a node point at the smallest around it
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: smaller neighbours and the node itself point at the smallest of them
        down = large.filter("a > b").distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .filter("a > b")
            .distinct()
        )
        edges = stored(small.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("b")
        ).first()
        if now == seen or now[0] == now[2]:
            # each node that is not a root points at one node: done once that is stable
            if now == seen or edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
                return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = now
