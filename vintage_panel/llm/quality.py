"""Quality rules with thresholds that follow the data, by DataFrame and SQL functions alone.

Word, line and symbol statistics are computed per document.  Per language and source a
mergeable quantile sketch of each statistic is kept: counts on a fixed grid of whole
thousandths, so partial sketches merge by adding and any order of merging gives the same
quantiles.  Sketches of a language's sources merge into the language's, and those into one of
all rows.  The thresholds read from the sketches replace fixed cutoffs and are joined back; a
group of few rows leans on the group above it, so that it cannot set its own limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE_RUN, SPACES, stored

SYMBOLS = "#*$%&|<>"  # fixed value
WINDOW = 8
# a statistic is out of line beyond its upper quartile plus this many quartile distances,
# and by no less than the slack, both on the grid of thousandths
REACH = 3
SLACK = {"symbols": 60, "dup_lines": 300, "repeats": 150, "capitals": 300, "word_length": 4000}
# the edge of a group of n rows is lowered toward that of the group above it, which counts as
# so many rows; above the group of all rows stand these
WEIGHT = 20
PRIOR = {"symbols": 100, "dup_lines": 300, "repeats": 300, "capitals": 400, "word_length": 12000}
LONGEST = 1_000_000  # longer mean word lengths, in thousandths, share the last place of the grid


def _repeat_words(n: str = "n", w: str = "w") -> str:
    """SQL: words in 8-word windows that occur twice or more in the array ``w`` of ``n`` words."""
    windows = (
        f"if({n} < {WINDOW + 1}, cast(array() as array<struct<h: bigint, p: int>>), "
        f"array_sort(transform(sequence(0, {n} - {WINDOW}), p -> "
        f"struct(xxhash64(slice({w}, p + 1, {WINDOW})) as h, p as p))))"
    )
    # neighbours with the same hash; then the starts in order, each covering up to the next
    starts = (
        "array_sort(transform(filter(s, (x, i) -> (i > 0 and s[i - 1].h = x.h) or "
        "(i < size(s) - 1 and s[i + 1].h = x.h)), x -> x.p))"
    )
    covered = (
        f"aggregate(t, named_struct('n', 0L, 'upto', 0), (a, p) -> named_struct("
        f"'n', a.n + p + {WINDOW} - greatest(p, a.upto), 'upto', p + {WINDOW}), a -> a.n)"
    )
    return f"transform(array({windows}), s -> transform(array({starts}), t -> {covered})[0])[0]"


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_capitals.  NULL text counts as empty; whole texts are read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col("lang").alias("lang"),
        F.col("source").alias("source"),
        text.alias("t"),
    )
    has_word = lambda x: F.length(F.translate(x, SPACES, "")) > 0
    return (
        base.withColumn("w", F.filter(F.split("t", SPACE_RUN), lambda x: x != ""))
        .withColumn("n", F.size("w"))
        .withColumn("lines", F.filter(F.split("t", "\n"), has_word))
        .select(
            "doc_id",
            "lang",
            "source",
            F.col("n").cast("long").alias("n_words"),
            F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
            (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.expr(_repeat_words()).cast("long").alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")))
            .cast("long")
            .alias("n_capitals"),
        )
    )


def _grid() -> dict[str, Column]:
    """Each statistic as whole thousandths."""

    def part(of: str, whole: str) -> Column:
        return F.expr(f"if({whole} > 0, {of} * 1000 div {whole}, 0L)")

    return {
        "symbols": part("n_symbols", "word_chars"),
        "dup_lines": part("n_dup_lines", "n_lines"),
        "repeats": part("n_repeat_words", "n_words"),
        "capitals": part("n_capitals", "word_chars"),
        "word_length": F.least(part("word_chars", "n_words"), F.lit(LONGEST).cast("long")),
    }


def sketches(stats: DataFrame) -> DataFrame:
    """Mergeable quantile sketches: lang, source, metric, value (thousandths), n."""
    grid = _grid()
    pairs = F.explode(
        F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in grid.items()])
    )
    return (
        stats.filter("n_words > 0")
        .select("lang", "source", pairs.alias("m"))
        .groupBy("lang", "source", F.col("m.metric").alias("metric"), F.col("m.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _values(of: dict[str, int]) -> Column:
    """A number per metric."""
    return F.create_map(*[F.lit(x) for kv in of.items() for x in kv])[F.col("metric")].cast("long")


def _own_edges(sketch: DataFrame, *by: str) -> DataFrame:
    """Per ``by`` and metric of merged sketches: own (edge by this group alone) and n (its rows)."""
    merged = sketch.groupBy(*by, "metric", "value").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "metric")  # at most as many rows as the grid has places
    ranked = (
        merged.withColumn("upto", F.sum("n").over(group.orderBy("value")))
        .withColumn("total", F.sum("n").over(group))
        .withColumn("low", F.min(F.expr("if(upto * 4 >= total, value, null)")).over(group))
        .withColumn("high", F.min(F.expr("if(upto * 4 >= total * 3, value, null)")).over(group))
    )
    reach = F.greatest((F.col("high") - F.col("low")) * REACH, _values(SLACK))
    return ranked.groupBy(*by, "metric").agg(F.max(F.col("high") + reach).alias("own"), F.max("total").alias("n"))


def _lowered(above: Column) -> Column:
    """The group's own edge, or the mean of it and the one above, weighted by rows, if that is lower."""
    blend = F.call_function("div", F.col("own") * F.col("n") + above * WEIGHT, F.col("n") + WEIGHT)
    return F.least(F.col("own"), blend)


def thresholds(sketch: DataFrame) -> DataFrame:
    """Per lang and source: one upper threshold per metric (columns edge_...)."""
    root = _own_edges(sketch).select("metric", _lowered(_values(PRIOR)).alias("root"))
    of_lang = (
        _own_edges(sketch, "lang").join(root, "metric").select(F.col("lang").alias("l"), "metric", _lowered(F.col("root")).alias("above"))
    )
    own = _own_edges(sketch, "lang", "source")
    edges = own.join(of_lang, own["lang"].eqNullSafe(of_lang["l"]) & (own["metric"] == of_lang["metric"])).select(
        "lang", "source", own["metric"], _lowered(F.col("above")).alias("edge")
    )
    return edges.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == k, F.col("edge"))).alias(f"edge_{k}") for k in SLACK]
    )


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its statistics, base_failed, kept and the rule that failed first.

    base_failed: fewer than 20 words, or more than 30 % of the words in repeated 8-word
    windows.  kept: not base_failed and no statistic above the threshold of its language and
    source (NULL is a group of its own), which few rows cannot raise above that of their language,
    nor few rows of a language above that of all rows.  Rows without words fail the base rule.  Repeated
    rows get the same result each; an empty table gives no rows; other columns are not read.
    """
    stats = stored(statistics(docs, id_col, text_col))
    # stored too: one row per language and source, and Spark sees how small it is
    limits = stored(thresholds(stored(sketches(stats)))).select(
        F.col("lang").alias("l"), F.col("source").alias("s"), *[f"edge_{k}" for k in SLACK]
    )
    joined = stats.join(
        limits, stats["lang"].eqNullSafe(limits["l"]) & stats["source"].eqNullSafe(limits["s"]), "left"
    )
    base_failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    rule = F.when(base_failed, F.lit("base"))
    for name, value in _grid().items():
        rule = rule.when(value > F.col(f"edge_{name}"), F.lit(name))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        rule.isNull().alias("kept"),
        rule.alias("rule"),
    )
