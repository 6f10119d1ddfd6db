"""Feature screening: coercion, missing rates, cardinality, correlation, cleaning.

Each rule looks at all columns in one pass.  What reaches the driver is one number per
column or per pair of columns, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import codes
from .comoments import pair_moments
from .selection import summaries

# a sum of squares below this share of the one it was centred out of is rounding noise of a constant
NOISE = 1e-12
# and so is a variance below this share of the squared mean
RESOLUTION = 1e-28


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def parse_number(c: Column) -> Column:
    """Number in a text, else NULL.  Spark also reads ``1d`` and ``1f``; those are not
    numbers here, and NaN counts as missing."""
    value = c.try_cast("double")
    return F.when(~c.rlike(r"[0-9.][dDfF]\s*$") & ~F.isnan(value), value)


def is_missing(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _long(row: DataFrame, cols: Sequence[str], name: str, value: str) -> DataFrame:
    """One-row aggregate -> one row per column."""
    return row.unpivot([], [_q(c) for c in cols], name, value)


# ---------------------------------------------------------------- numeric coercion
def numeric_shares(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Per string column: non-null values, how many parse as numbers, and the verdict."""
    cols = string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column string, non_null bigint, parsed bigint, numeric boolean"
        )
    counts = [
        F.struct(F.lit(c).alias("column"), F.count(_q(c)).alias("non_null"), F.count(parse_number(_q(c))).alias("parsed"))
        for c in cols
    ]
    share = F.try_divide(F.col("parsed"), F.col("non_null"))
    return (
        df.agg(F.array(*counts).alias("__counts"))
        .select(F.inline("__counts"))
        .withColumn("numeric", F.coalesce(share > threshold, F.lit(False)))
    )


def _coerced(df: DataFrame, numeric: set[str]) -> DataFrame:
    if not numeric:
        return df
    return df.select(
        *[parse_number(_q(c)).alias(c) if c in numeric else _q(c) for c in df.columns]
    )


def coerce_numeric(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """String columns whose non-null values parse by more than ``threshold`` become double;
    their other values become NULL.  Runs one aggregate job to decide."""
    stats = _profile(df)
    return _coerced(df, {c for c, s in stats.items() if s.reads_as_number(threshold)})


# ---------------------------------------------------------------- name and type rules
def name_rules(
    columns: Sequence[str],
    contains: Sequence[str] = codes.DROP_FRAGMENTS,
    prefixes: Sequence[str] = codes.DROP_PREFIXES,
    names: Sequence[str] = (),
) -> list[str]:
    """Columns to drop by name; all comparisons ignore case."""
    exact = {n.upper() for n in names}
    return [
        c
        for c in columns
        if c.upper() in exact
        or any(part.upper() in c.upper() for part in contains)
        or any(c.upper().startswith(p.upper()) for p in prefixes)
    ]


def force_drop(
    df: DataFrame,
    contains: Sequence[str] = codes.DROP_FRAGMENTS,
    prefixes: Sequence[str] = codes.DROP_PREFIXES,
    names: Sequence[str] = (),
    protected: Sequence[str] = (),
) -> DataFrame:
    return df.drop(
        *[c for c in name_rules(df.columns, contains, prefixes, names) if c not in protected]
    )


def drop_non_numeric(df: DataFrame, protected: Sequence[str] = ()) -> DataFrame:
    keep = set(numeric_columns(df)) | set(protected)
    return df.select(*[_q(c) for c in df.columns if c in keep])


# ---------------------------------------------------------------- missing rates
def missing_rates(df: DataFrame) -> DataFrame:
    """Share of missing values per column."""
    row = df.agg(
        *[
            F.avg(is_missing(_q(f.name), f.dataType).cast("double")).alias(f.name)
            for f in df.schema.fields
        ]
    )
    return _long(row, df.columns, "column", "missing_rate")


def drop_high_missing(
    df: DataFrame, threshold: float = 0.3, protected: Sequence[str] = ()
) -> DataFrame:
    high = missing_rates(df).filter(F.col("missing_rate") > threshold).collect()
    return df.drop(*[r["column"] for r in high if r["column"] not in protected])


def top_missing(df: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` columns with the highest missing rate; ties by name."""
    return missing_rates(df).orderBy(F.desc("missing_rate"), "column").limit(n)


# ---------------------------------------------------------------- cardinality
def cardinalities(
    df: DataFrame, cols: Sequence[str] | None = None, rsd: float | None = None
) -> DataFrame:
    """Distinct non-null values per column; ``rsd`` switches to a sketch."""
    cols = string_columns(df) if cols is None else list(cols)
    count = F.count_distinct if rsd is None else (lambda c: F.approx_count_distinct(c, rsd))
    return _long(df.agg(*[count(_q(c)).alias(c) for c in cols]), cols, "column", "n_distinct")


def sketch_error(limit: int) -> float:
    """Relative error that makes a sketch's estimate of over twice ``limit`` a proof.

    A sketch has about ``(1.106 / error) ** 2`` registers, rounded up to a power of two.  Up
    to ``limit`` values touch as many registers at most; with 2.5 registers for each, linear
    counting gives no more than ``2.5 * ln(2.5 / 1.5) < 1.3`` times the limit.
    """
    return min(0.05, 1.106 / (2.5 * max(limit, 1)) ** 0.5)


def _sketch_proves_more(estimate: int, limit: int) -> bool:
    return estimate > 2 * limit


def _within(df: DataFrame, estimates: dict[str, int], limit: int) -> dict[str, int]:
    """Exact distinct counts of the columns the sketch does not rule out."""
    open_cols = [c for c, e in estimates.items() if not _sketch_proves_more(e, limit)]
    if not open_cols:
        return {}
    row = df.agg(*[F.count_distinct(_q(c)).alias(c) for c in open_cols]).first()
    return {c: row[c] for c in open_cols if row[c] <= limit}


def low_cardinality(df: DataFrame, cols: Sequence[str], limit: int = 50) -> dict[str, int]:
    """Columns with at most ``limit`` distinct values, with their exact counts.

    A sketch pass first rules out columns that are surely above the limit, so ids and
    free text are never shuffled to be counted.  The answer is exact.
    """
    if not cols:
        return {}
    row = df.agg(*[F.approx_count_distinct(_q(c), sketch_error(limit)).alias(c) for c in cols]).first()
    return _within(df, {c: row[c] for c in cols}, limit)


def high_cardinality(df: DataFrame, limit: int = 50) -> list[str]:
    cols = string_columns(df)
    low = low_cardinality(df, cols, limit)
    return [c for c in cols if c not in low]


# ---------------------------------------------------------------- correlation
def _finite(df: DataFrame, name: str) -> Column:
    c = _q(name).cast("double")
    return F.when(~F.isnan(c), c)


def _pair_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, corr) of all pairs of columns, NULL where one does not vary."""
    sums = pair_moments(df.select(*[_finite(df, c).alias(f"c{k}") for k, c in enumerate(cols)]))
    n = F.col("n")

    def varies(c: str) -> Column:
        # a constant column (where the other is known) has no correlation, only rounding noise
        mean = F.col(f"a{c}") + F.col(f"m{c}")
        return F.col(f"s{c}{c}") > F.greatest(F.col(f"q{c}") * NOISE, n * mean * mean * RESOLUTION)

    spread = (n > 1) & varies("x") & varies("y")
    corr = F.try_divide(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy"))
    return sums.select("i", "j", F.when(spread, corr).alias("corr"))


def correlation_pairs(
    df: DataFrame, cols: Sequence[str] | None = None, above: float | None = None
) -> DataFrame:
    """Pearson correlation of pairs of numeric columns over rows where both are known.

    With ``above``, only the pairs whose correlation exceeds it in size.  One scan whatever the
    number of columns (see ``comoments``).  Pairs that meet an infinity have none.
    """
    cols = numeric_columns(df) if cols is None else list(cols)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "left string, right string, corr double")
    names = F.array(*[F.lit(c) for c in cols])
    pairs = _pair_correlations(df, cols).select(
        F.get(names, F.col("i")).alias("left"),
        F.get(names, F.col("j")).alias("right"),
        F.when(~F.isnan("corr"), F.col("corr")).alias("corr"),
    )
    return pairs if above is None else pairs.filter(F.abs("corr") > above)


def correlated_columns(
    df: DataFrame, cols: Sequence[str], threshold: float = 0.95
) -> tuple[list[str], DataFrame]:
    """Columns too close to an earlier one, and the offending pairs.

    Not greedy: a column that is itself marked still marks later ones.
    """
    pairs = correlation_pairs(df, cols, threshold)
    marked = {r["right"] for r in pairs.select("right").distinct().collect()}
    return [c for c in cols if c in marked], pairs


def correlation_prune(
    df: DataFrame,
    threshold: float = 0.95,
    target: str | None = None,
    protected: Sequence[str] = (),
) -> DataFrame:
    cols = [c for c in numeric_columns(df) if c != target]
    marked, _ = correlated_columns(df, cols, threshold)
    return df.drop(*[c for c in marked if c not in protected])


# ---------------------------------------------------------------- target summary
def exact_median(df: DataFrame, col: str) -> float | None:
    """Median without gathering the values, in at most four scans (see ``selection``).

    ``median``/``percentile`` would build one map of all distinct values in one task.
    Infinities are ordinary values; NaN counts as missing.
    """
    return summaries(df, [_q(col)])[0].median


def target_summary(df: DataFrame, col: str, top: int = 10) -> DataFrame:
    """Numeric column: counts and moments, from at most four scans that run here.  Other column:
    its ``top`` values with share.
    """
    dtype = df.schema[col].dataType
    c = _q(col)
    if is_numeric(dtype):
        s = summaries(df, [c])[0]
        row = (s.rows, s.rows - s.known if s.rows else None, s.mean, s.median, s.std, s.low, s.high)
        return df.sparkSession.createDataFrame(
            [row], "observations long, missing long, mean double, median double, std double, min double, max double"
        )
    rows = df.select(F.count(F.lit(1)).alias("n")).scalar()
    return (
        df.filter(c.isNotNull())
        .groupBy(c.alias("value"))
        .agg(F.count(F.lit(1)).alias("observations"))
        .orderBy(F.desc("observations"), "value")
        .limit(top)
        .withColumn("share", F.try_divide(F.col("observations"), rows))
    )


# ---------------------------------------------------------------- the whole cleaning
@dataclass(frozen=True)
class CleanSpec:
    """Limits of :func:`clean_features`."""

    missing: float = 0.3
    protected: tuple[str, ...] = ()
    drop_categorical: bool = True
    cardinality: int = 50
    target: str | None = None
    correlation: float = 0.95
    force_drop: tuple[str, ...] = ()
    numeric_share: float = 0.8

    def kept(self) -> list[str]:
        """Columns that survive every rule."""
        return list(dict.fromkeys([*self.protected, *([self.target] if self.target else [])]))


@dataclass(frozen=True)
class _Stats:
    rows: int
    known: int
    parsed: int | None
    sketch: int | None

    def reads_as_number(self, threshold: float) -> bool:
        return self.parsed is not None and self.known > 0 and self.parsed / self.known > threshold


def _profile(df: DataFrame, limit: int = 50) -> dict[str, _Stats]:
    """Counts of known and parsed values and distinct-value sketches, in one job."""
    text = set(string_columns(df))
    exprs = [F.count(F.lit(1)).alias("rows")]
    for k, f in enumerate(df.schema.fields):
        c = _q(f.name)
        exprs.append(F.count(F.when(~is_missing(c, f.dataType), 1)).alias(f"known_{k}"))
        if f.name in text:
            exprs.append(F.count(parse_number(c)).alias(f"parsed_{k}"))
            exprs.append(F.approx_count_distinct(c, sketch_error(limit)).alias(f"sketch_{k}"))
    row = df.agg(*exprs).first().asDict()
    return {
        name: _Stats(row["rows"], row[f"known_{k}"], row.get(f"parsed_{k}"), row.get(f"sketch_{k}"))
        for k, name in enumerate(df.columns)
    }


def _verdicts(df: DataFrame, spec: CleanSpec, stats: dict[str, _Stats], low: dict[str, int]) -> dict[str, str]:
    """The first rule that drops each column, from its name, type and statistics alone."""
    out: dict[str, str] = {}
    for name, stat in stats.items():
        number = stat.reads_as_number(spec.numeric_share)
        text = isinstance(df.schema[name].dataType, T.StringType) and not number
        known = stat.parsed if number else stat.known
        rules = {
            "force_dropped": name in spec.force_drop,
            "high_missing": stat.rows > 0 and 1 - known / stat.rows > spec.missing,
            "high_cardinality": text and name not in low,
            "non_numeric": spec.drop_categorical and not number and not is_numeric(df.schema[name].dataType),
        }
        broken = [rule for rule, holds in rules.items() if holds]
        if broken and name not in spec.kept():
            out[name] = broken[0]
    return out


def clean_features(df: DataFrame, spec: CleanSpec = CleanSpec()) -> tuple[DataFrame, DataFrame]:
    """Cleaned frame with upper-case names, and a log of (rule, column).

    Each column gets one verdict: dropped by the first rule that it breaks (name, missing
    rate, cardinality, type, then correlation among what is left), or kept.  Protected columns
    and the target survive every rule.  The schema depends on the data, so up to four
    aggregate jobs run here; the returned frame itself is lazy.  Store a frame that is costly
    to compute first (``materialize``).
    """
    stats = _profile(df, spec.cardinality)
    numeric = {c for c, s in stats.items() if s.reads_as_number(spec.numeric_share)}
    open_text = {c: s.sketch for c, s in stats.items() if s.sketch is not None and c not in numeric}
    verdicts = _verdicts(df, spec, stats, _within(df, open_text, spec.cardinality))
    left = _coerced(df, numeric).select(*[_q(c) for c in df.columns if c not in verdicts])
    if spec.target in left.columns:
        features = [c for c in numeric_columns(left) if c != spec.target]
        close, _ = correlated_columns(left, features, spec.correlation)
        verdicts |= {c: "high_correlation" for c in close if c not in spec.kept()}
    log = [("protected", c) for c in spec.kept() if c in df.columns] + [(r, c) for c, r in verdicts.items()]
    log_df = df.sparkSession.createDataFrame(
        [(rule, c.upper()) for rule, c in log], "rule string, column string"
    )
    return left.select(*[_q(c).alias(c.upper()) for c in left.columns if c not in verdicts]), log_df
