"""Licence scan by a trained paragraph classifier, with DataFrame and SQL functions alone.

Paragraphs become sparse counts of hashed words and word pairs.  A multinomial logistic
regression tells the licence families and an unknown class apart.  It is fitted on altered
copies of public licence wordings and a bounded sample of the corpus as the unknown class; a
held-out part of that sample calibrates the probability that a family must reach.  A hit
counts when enough of a template's word triples stand in the paragraph; a template of up to
``SHORT`` words, as a bare notice or a heading, is compared by its word pairs.

A paragraph is a line.  Notices wrapped over several lines are looked for too: words of a
document that stand close enough together and hold enough of a template are classified and
confirmed like a paragraph, from the first word in common to the last.

Some licences differ from a family by a word, such as Lesser or ShareAlike.  A confirmed notice that
holds such a word is the relative's (``RELATIVES``), never the family's.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .license_texts import RELATIVES, TEMPLATES

UNKNOWN = 0.0
FAMILIES = tuple(TEMPLATES)
SAMPLE = 20_000  # paragraphs, about, that stand for the unknown class, chosen by a hash
VARIANTS = 60  # altered copies of each template
FEATURES = 1 << 15
LEAST = 0.5  # a family's probability is never below this
SHARE = 0.6  # of a template's word triples, for a confirmed hit
SPREAD = 1.5  # a wrapped notice spans at most so many times its template's words
SHORT = 5  # templates of so few words are compared by pairs and learned whole


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _grams(words: Column) -> Column:
    """Words and word pairs."""
    pairs = F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def _runs(words: Column, size: int) -> Column:
    """The distinct runs of ``size`` words; all words as one run where there are fewer."""
    at = F.expr("0")
    starts = F.when(F.size(words) >= size, F.sequence(at, F.size(words) - size)).otherwise(F.array(F.lit(0)))
    return F.array_distinct(F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i + 1, size))))


def paragraphs(docs: DataFrame, id_col: str, text_col: str, wrapped: bool = False) -> DataFrame:
    """One row per line that holds a word, and one without a paragraph where there is none.

    ``row`` numbers the rows of ``docs``, so rows that repeat an id stay apart.  ``first`` and
    ``last`` are the line's place.  ``wrapped`` adds a row per run of words over several lines
    that holds enough of a template, with that template's ``family`` (NULL for lines).
    """
    lines = F.filter(
        F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), tokens), lambda w: F.size(w) > 0
    )
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), lines.alias("lines")
    )
    found = F.expr(
        "transform(lines, (w, i) -> "
        "named_struct('words', w, 'first', i, 'last', i, 'family', cast(null as double)))"
    )
    if wrapped:
        numbered = numbered.withColumn("flat", F.flatten("lines")).withColumn("shared", F.expr(_shared_runs()))
        found = F.when(F.size("shared") > 0, F.concat(found, F.expr(_wrapped()))).otherwise(found)
    return numbered.select("row", "doc_id", F.explode_outer(found).alias("p")).select("row", "doc_id", "p.*")


def _shared_runs() -> str:
    """SQL: where a template's pair or triple starts in ``flat``, and which, if a document has several lines."""
    own = {size: sorted({g for ts in TEMPLATES.values() for t in ts for s, gs in [_own_runs(t)] if s == size for g in gs})
           for size in (2, 3)}
    among = {size: ", ".join(f"'{g}'" for g in gs) for size, gs in own.items()}
    # most words begin none of them, and then no text is made
    begin = {size: ", ".join(f"'{w}'" for w in sorted({g.split()[0] for g in gs})) for size, gs in own.items()}

    def starts(size: int) -> str:
        text = "concat_ws(' ', " + ", ".join(["x", *(f"get(flat, i + {k})" for k in range(1, size))]) + ")"
        marked = f"transform(flat, (x, i) -> if(x in ({begin[size]}) and {text} in ({among[size]}), named_struct('at', i, 'g', {text}), null))"
        return f"filter({marked}, m -> m is not null)"

    none = "cast(array() as array<struct<at: int, g: string>>)"
    return f"if(size(lines) > 1, array_sort(concat({starts(2)}, {starts(3)})), {none})"


def _wrapped() -> str:
    """SQL: runs of words over several lines that hold enough of a template's pairs or triples."""
    known = ", ".join(
        f"named_struct('family', {i + 1}D, 'size', {size}, 'span', {math.ceil(SPREAD * len(re.findall('[a-z0-9]+', t.lower())))}, "
        f"'least', {math.ceil(SHARE * len(gs) - 1e-9)}, 'g', array({', '.join(repr(g) for g in gs)}))"
        for i, name in enumerate(FAMILIES) for t in TEMPLATES[name] for size, gs in [_own_runs(t)]
    )
    # what the document has of a template; then from each of it, what follows within the span
    mine = "filter(shared, x -> array_contains(t.g, x.g))"
    near = "filter(slice(m, i + 1, t.span), y -> y.at < x.at + t.span)"
    ends = (
        f"filter(transform(m, (x, i) -> transform(array({near}), n -> named_struct('from', x.at, "
        "'upto', element_at(n, -1).at + t.size, 'held', size(array_distinct(transform(n, y -> y.g)))))[0]), "
        "e -> e.held >= t.least)"
    )
    # the first of those that overlap
    apart = (
        "aggregate(e, named_struct('upto', 0, 'kept', cast(array() as array<struct<from: int, upto: int>>)), "
        "(a, x) -> if(x.from >= a.upto, named_struct('upto', x.upto, 'kept', "
        "concat(a.kept, array(named_struct('from', x.from, 'upto', x.upto)))), a), a -> a.kept)"
    )
    per_template = (
        f"transform(filter(transform(array({known}), t -> named_struct('t', t, 'm', {mine})), "
        "u -> size(u.m) >= u.t.least), u -> transform(array(u.t), t -> transform(array(u.m), m -> "
        f"transform(array({ends}), e -> transform({apart}, k -> named_struct('words', "
        "slice(flat, k.from + 1, k.upto - k.from), 'first', line_of[k.from], 'last', line_of[k.upto - 1], "
        "'family', t.family)))[0])[0])[0])"
    )
    line_of = "flatten(transform(lines, (w, i) -> array_repeat(i, size(w))))"
    return f"transform(array({line_of}), line_of -> filter(flatten({per_template}), r -> r.first < r.last))[0]"


def _templates(docs: DataFrame) -> DataFrame:
    rows = [(float(i + 1), t) for i, name in enumerate(FAMILIES) for t in TEMPLATES[name]]
    return docs.sparkSession.createDataFrame(rows, "label double, text string").select(
        "label", "text", tokens(F.col("text")).alias("words")
    )


def _own_runs(template: str) -> tuple[int, list[str]]:
    """The word triples of a template, or the pairs of a short one; templates are in ASCII letters."""
    words = re.findall("[a-z0-9]+", template.lower())
    size = 2 if len(words) <= SHORT else 3
    return size, sorted({" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))})


def _held(words: Column, label: float | None = None) -> Column:
    """Largest share of a template's runs that stand in the paragraph, over a family or all."""
    names = FAMILIES if label is None else [FAMILIES[int(label) - 1]]
    own = [_own_runs(text) for name in names for text in TEMPLATES[name]]

    def largest(mine: Column) -> Column:
        shares = [
            F.size(F.array_intersect(mine[f"of{size}"], F.array(*[F.lit(x) for x in t]))) / F.lit(float(len(t)))
            for size, t in own
        ]
        return F.greatest(*shares, F.lit(0.0))

    # the paragraph's runs are made once, not once per template
    mine = F.struct(_runs(words, 2).alias("of2"), _runs(words, 3).alias("of3"))
    return F.element_at(F.transform(F.array(mine), largest), 1)


def _named(words: Column, label: Column) -> Column:
    """The name of a confirmed family, or of the relative whose word stands in the notice."""
    names = F.array(*[F.lit(n) for n in FAMILIES])
    # "Share-Alike" is two words
    told = F.concat(words, F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.concat(a, b)))
    name = F.element_at(names, label.cast("int"))
    for family, relatives in RELATIVES.items():
        mine = F.element_at(names, label.cast("int")) == family
        # a notice with the words of several is the first one's
        for relative, marks in reversed(relatives):
            name = F.when(mine & F.arrays_overlap(told, F.array(*[F.lit(m) for m in marks])), relative).otherwise(name)
    return name


def _lent(words: Column) -> Column:
    """Share of the paragraph's word triples that stand in any template."""
    lent = sorted({g for ts in TEMPLATES.values() for t in ts for size, gs in [_own_runs(t)] if size == 3 for g in gs})
    return F.element_at(F.transform(F.array(_runs(words, 3)), lambda mine: (
        F.size(F.filter(mine, lambda g: g.isin(lent))) / F.size(mine))), 1)


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(label, words, draw): templates with words left out, and sampled paragraphs as unknown.

    Short templates stay whole: what is left of them would be a word or two of any text.
    """
    kept = F.filter(
        F.col("words"),
        lambda w, i: (F.size("words") <= SHORT)
        | (F.pmod(F.xxhash64(w, i, F.col("variant")), F.lit(100)) >= F.col("variant") % 12),
    )
    known = (
        _templates(docs)
        .withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
        .select("label", kept.alias("words"), F.xxhash64("text", "variant").alias("draw"))
        .filter(F.size("words") > 0)
    )
    lines = paragraphs(docs, id_col, text_col).filter("words is not null")
    # by a hash of the words: the same paragraphs whatever the partitions, and none gathered to be sorted
    n = docs.agg(F.sum(F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")))).first()[0] or 1
    draw = F.xxhash64("words")
    sample = lines.select("words", draw.alias("draw")).filter(
        F.pmod(draw, F.lit(1 << 31)) < F.lit(min(1.0, SAMPLE / n) * (1 << 31))
    )
    # a line of a wrapped notice holds little of the template, yet little else
    unknown = sample.distinct().filter((_held(F.col("words")) < 0.3) & (_lent(F.col("words")) < 0.5))
    return known.unionByName(unknown.select(F.lit(UNKNOWN).alias("label"), "words", "draw"))


def _vectors(rows: DataFrame) -> DataFrame:
    hashed = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    return hashed.transform(rows.withColumn("grams", _grams(F.col("words"))))


def fit_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[LogisticRegressionModel, float]:
    """(model, probability that a family must reach)."""
    # some ten thousand rows whatever the corpus: each step of the fit is a few tasks
    rows = stored(_vectors(training_rows(docs, id_col, text_col)).select("label", "features", "draw")).coalesce(4)
    part = F.pmod("draw", F.lit(4))
    model = LogisticRegression(maxIter=40, regParam=1e-4, family="multinomial").fit(rows.filter(part != 0))
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES)))
    worst = model.transform(rows.filter((part == 0) & (F.col("label") == UNKNOWN))).agg(F.max(best)).first()[0]
    return model, min(max(LEAST, worst or 0.0), 0.95)


def scan_licenses(
    docs: DataFrame, model: LogisticRegressionModel, least: float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_paragraphs, n_licensed, families, best_probability.

    Paragraphs are lines with a letter or digit; every one is classified, and so are runs of
    words over several lines that hold enough of a template.  n_licensed counts the lines that
    are confirmed or take part in a confirmed run.  ``families`` lists
    the confirmed ones and their relatives, sorted, joined by commas; it is empty and best_probability NULL where
    there is none, as for NULL and empty texts.  Repeated rows get the same result each; an
    empty table gives no rows; other columns are not read.
    """
    rows = paragraphs(docs, id_col, text_col, wrapped=True)
    scored = model.transform(
        _vectors(rows.withColumn("full", F.col("words").isNotNull() & F.col("family").isNull()).withColumn(
            "words", F.coalesce("words", F.array().cast("array<string>"))))
    )
    probability = F.element_at(vector_to_array("probability"), (F.col("prediction") + 1).cast("int"))
    confirmed = F.lit(False)
    for i, _ in enumerate(FAMILIES):
        of_family = (F.col("prediction") == i + 1.0) & (F.col("p") >= least)
        confirmed = F.when(of_family, _held(F.col("words"), i + 1) >= SHARE).otherwise(confirmed)
    hits = scored.select(
        "row", "doc_id", "full", "first", "last", "words", "prediction", probability.alias("p")
    ).withColumn("hit", F.col("first").isNotNull() & confirmed)
    named = F.when(F.col("hit"), _named(F.col("words"), F.col("prediction")))
    licensed = F.collect_set(F.when(F.col("hit"), F.sequence("first", "last")))
    return (
        hits.groupBy("row", "doc_id")
        .agg(
            F.count_if("full").alias("n_paragraphs"),
            F.size(F.array_distinct(F.flatten(licensed))).cast("long").alias("n_licensed"),
            F.array_join(F.array_sort(F.collect_set(named)), ",").alias("families"),
            F.max(F.when(F.col("hit"), F.col("p"))).alias("best_probability"),
        )
        .drop("row")
    )
