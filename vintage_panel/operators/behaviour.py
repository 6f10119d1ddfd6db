"""Account-by-month behaviour panel: enrichment, monthly roll-ups, aggregate, extract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from ..functions.dates import year_quarter
from ..functions.packing import Code, Day, Field, Label, Number, Packing
from ..functions.scalars import (
    band,
    date_band_rate,
    map_labels,
    padded_int,
    pattern_tag,
    test_segment,
    threshold_flag,
)
from ..sources.io import in_window
from .lookups import acquisition_cost
from .skew import lookup_join


@dataclass(frozen=True)
class EnrichSpec:
    """Which attribute columns become tags, flags, counts and behaviour labels."""

    patterns: tuple[str, ...] = tuple(f"pattern{k}" for k in range(1, 16))
    balances: tuple[str, ...] = tuple(f"bal{k}" for k in range(1, 6))
    counts: tuple[str, ...] = tuple(f"cnt{k}" for k in range(1, 15))
    bureau_codes: tuple[str, ...] = ("rv78", "rv79", "rv81")
    application_codes: tuple[str, ...] = ("rv80",)
    start: date | None = date(2023, 1, 1)
    end: date | None = date(2026, 1, 1)
    closed: str = "both"

    @property
    def behaviour_codes(self) -> tuple[str, ...]:
        return self.application_codes + self.bureau_codes


BEHAVIOURS = Label((*codes.BEHAVIOUR_CODES.values(), codes.BEHAVIOUR_DEFAULT))
FLAG = Number(2)


def report_packing(spec: EnrichSpec) -> Packing:
    """Tags and flags of a report as bits, for the joins that carry them."""
    tags = {f"{c}_tag": BEHAVIOURS for c in spec.patterns}
    return Packing(tags | {f"{c}_flag": FLAG for c in spec.balances}, "__marks")


def key_packings(spec: EnrichSpec) -> tuple[Packing, Packing]:
    """What the panel's keys take from a report, besides tags and flags, and from an application, as bits."""
    of_report = [*[f"behaviour_{c}" for c in spec.bureau_codes], *spec.counts]
    of_application = [*[f"behaviour_{c}" for c in spec.application_codes], "credit_band", "acq_risk_tier"]
    fields = panel_fields(spec)
    return (
        Packing({n: fields[n] for n in of_report}, "__report"),
        Packing({n: fields[n] for n in of_application}, "__application"),
    )


def _with_keys(df: DataFrame, packing: Packing, labels: Mapping[str, Column]) -> DataFrame:
    """``df`` plus the integers of ``packing``, from ``labels`` or columns of the key's name."""
    kept = [F.col(f"`{c}`") for c in df.columns]
    keys = [labels.get(n, F.col(n)).alias(f"__key_{n}") for n in packing.fields]
    return df.select(*kept, *keys).select(*kept, *packing.columns("__key_{}"))


def channel_label(c: Column) -> Column:
    return map_labels(c, codes.PANEL_CHANNELS, codes.PANEL_CHANNEL_DEFAULT)


def behaviour_label(c: Column) -> Column:
    return map_labels(c, codes.BEHAVIOUR_CODES, codes.BEHAVIOUR_DEFAULT)


def credit_band(c: Column) -> Column:
    return band(c, codes.CREDIT_BANDS, codes.CREDIT_BANDS_DEFAULT)


def line_segment(bucket: Column, entry: Column) -> Column:
    return test_segment(
        bucket, entry, codes.ARM_CHANGE, codes.ARMS_BEFORE, codes.ARMS_AFTER, "Line"
    )


def price_segment(bucket: Column, entry: Column) -> Column:
    return test_segment(
        bucket, entry, codes.ARM_CHANGE, codes.ARMS_BEFORE, codes.ARMS_AFTER, "Pricing"
    )


def entered(perf: DataFrame, spec: EnrichSpec = EnrichSpec()) -> DataFrame:
    """Performance rows of accounts entered in the window."""
    return perf.filter(in_window(F.col("entry_date"), spec.start, spec.end, spec.closed))


def enrich_performance(
    perf: DataFrame,
    apps: DataFrame,
    bureau: DataFrame,
    spec: EnrichSpec = EnrichSpec(),
    *,
    hot: DataFrame | tuple | None = None,
    packed: bool = False,
    keyed: bool = False,
) -> DataFrame:
    """Performance rows of accounts entered in the window, with application and bureau
    attributes, tags, flags, test arms and score band.

    Applications and reports are joined first: they hold one row per application, the
    performance table one per account and month, so it is shuffled once only.  Tags and flags
    travel as bits; ``packed`` leaves them so for further joins, until :func:`unpacked`.  ``keyed``
    adds the integers that :func:`behaviour_aggregate` groups by, made once per report and application
    and not once per row; a key that does not fit raises there, even if no row meets it.
    """
    packing = report_packing(spec)
    report = bureau.select(
        "report_id",
        *spec.bureau_codes,
        *spec.patterns,
        *[pattern_tag(F.col(c)).alias(f"{c}_tag") for c in spec.patterns],
        *[threshold_flag(F.col(c)).alias(f"{c}_flag") for c in spec.balances],
        *[padded_int(F.col(c)).alias(c) for c in spec.counts],
    )
    named = ["report_id", *spec.bureau_codes, *spec.patterns, *spec.counts]
    report = report.select(*named, *packing.columns())
    of_report, of_application = key_packings(spec)
    if keyed:
        labels = {f"behaviour_{c}": behaviour_label(F.col(c)) for c in spec.bureau_codes}
        report = _with_keys(report, of_report, labels)
    application = apps.select(
        "app_id",
        "report_id",
        *spec.application_codes,
        F.col("random02").alias("__random02"),
        F.col("random03").alias("__random03"),
        F.col("risk_tier").alias("acq_risk_tier"),
        credit_band(F.col("vantage")).alias("__credit_band"),
    )
    if keyed:
        labels = {f"behaviour_{c}": behaviour_label(F.col(c)) for c in spec.application_codes}
        application = _with_keys(application, of_application, labels | {"credit_band": F.col("__credit_band")})
    facts = application.join(report, "report_id", "left").drop("report_id")
    joined = lookup_join(entered(perf, spec), facts, "app_id", hot=hot)
    out = joined.select(
        *perf.columns,
        channel_label(F.col("channel")).alias("channel_label"),
        *spec.behaviour_codes,
        *spec.patterns,
        *packing.names,
        *spec.counts,
        line_segment(F.col("__random02"), F.col("entry_date")).alias("line_segment"),
        price_segment(F.col("__random03"), F.col("entry_date")).alias("price_segment"),
        "acq_risk_tier",
        F.coalesce(F.col("__credit_band"), F.lit(codes.CREDIT_BANDS_DEFAULT)).alias("credit_band"),
        *(_filled(spec) if keyed else []),
    )
    return out if packed else unpacked(out, spec, keyed)


def _filled(spec: EnrichSpec) -> list[Column]:
    """The integers of :func:`key_packings`; a row without a report or an application has the default labels."""
    of_report, of_application = key_packings(spec)
    behaviours = [{f"behaviour_{c}": codes.BEHAVIOUR_DEFAULT for c in cs} for cs in (spec.bureau_codes, spec.application_codes)]
    return [
        *of_report.filled(behaviours[0]),
        *of_application.filled(behaviours[1] | {"credit_band": codes.CREDIT_BANDS_DEFAULT}),
    ]


def unpacked(df: DataFrame, spec: EnrichSpec = EnrichSpec(), keyed: bool = False) -> DataFrame:
    """Tags and flags by name, out of the bits that :func:`enrich_performance` packed.

    ``keyed`` keeps the bits too, with the tags of a row without a report filled in.
    """
    packing = report_packing(spec)
    # an application without a report has no pattern, which reads as mixed
    mixed = f"coalesce({{}}, '{codes.BEHAVIOUR_DEFAULT}') as `{{}}`"
    tags = [mixed.format(packing.key(f"{c}_tag"), f"{c}_tag") for c in spec.patterns]
    flags = [f"{packing.key(f'{c}_flag')} as `{c}_flag`" for c in spec.balances]
    rest = [f"`{c}`" for c in df.columns if c not in packing.names]
    named = [F.expr(e) for e in (*rest, *tags, *flags)]
    mixed_tags = {f"{c}_tag": codes.BEHAVIOUR_DEFAULT for c in spec.patterns}
    return df.select(*named, *(packing.filled(mixed_tags) if keyed else []))


def max_mob(
    df: DataFrame, key: str = "account_id", mob: str = "mob", status: str = "status"
) -> DataFrame:
    return (
        df.filter(F.col(status).isin(*codes.MAX_MOB_STATUS))
        .groupBy(key)
        .agg(F.max(mob).alias("max_mob"))
    )


def mob_indicator(c: Column, horizon: int = 24) -> Column:
    """Accounts without a qualifying row (NULL) read as complete."""
    return F.when(c < horizon, f"Max MOB < {horizon}").otherwise(f"Max MOB >= {horizon}")


def max_mob_indicator(
    df: DataFrame,
    key: str = "account_id",
    mob: str = "mob",
    status: str = "status",
    *,
    hot: DataFrame | tuple | None = None,
) -> DataFrame:
    """``df`` plus the account's largest MOB over qualifying rows and its label."""
    return lookup_join(df, max_mob(df, key, mob, status), key, hot=hot).withColumn(
        "mob_indicator", mob_indicator(F.col("max_mob"))
    )


def _not_fraud() -> Column:
    return F.col("fraud_flag") == "N"


def _launched() -> Column:
    cond = F.lit(False)
    for phase in codes.LAUNCH_PHASES:
        cond = cond | F.col("launch_phase").startswith(phase)
    return cond


def _fraud_chargeoff() -> Column:
    status, reason = codes.FRAUD_CHARGEOFF
    return (F.col("status") == status) & (F.col("reason") == reason)


def _month_end_flagged() -> Column:
    return F.col("month_end_ind") == 1


def _fees_rows() -> Column:
    # "is false", not "is not true": a NULL reason on a charged-off account drops the row
    return _month_end_flagged() & ~_fraud_chargeoff() & _launched() & _not_fraud()


def _fees() -> dict[str, Column]:
    zero = F.lit(0.0)
    fee, late = F.col("monthly_fee"), F.coalesce(F.col("late_fee"), zero)
    return {
        "gross_sales": F.coalesce(F.col("merchant"), zero) + F.coalesce(F.col("cash"), zero),
        "net_late_fee": late - F.coalesce(F.col("late_fee_refund"), zero),
        "net_other_fee": F.when(fee >= codes.ANNUAL_FEE_LEVEL, fee - late).otherwise(fee),
        "net_annual_fee": F.coalesce(F.col("annual_fee"), zero),
        "monthly_interest": F.col("monthly_interest"),
        "monthly_fee": fee,
        "merch_apr": F.col("merch_apr"),
    }


# shown by monthly_fees as they are
FEE_PARTS = ("payment", "payment_reversal", "late_fee", "late_fee_refund", "annual_fee", "principal")


def _revolver_rows() -> Column:
    # "is not true": here a NULL reason keeps the row
    return (
        _not_fraud()
        & _launched()
        & ~F.coalesce(_fraud_chargeoff(), F.lit(False))
        & (F.col("accum_chargeoff") == 0)
    )


def month_end_principal(hist: DataFrame, key: str = "acct_id") -> DataFrame:
    return hist.filter(_month_end_flagged() & _not_fraud()).select(
        key,
        "load_date",
        F.last_day("load_date").alias("month_end"),
        "principal",
    )


def monthly_fees(hist: DataFrame, key: str = "acct_id") -> DataFrame:
    """Gross sales, net fees and their parts of flagged month ends in the launch phases."""
    return hist.filter(_fees_rows()).select(
        key,
        "load_date",
        F.last_day("load_date").alias("month_end"),
        *[c.alias(n) for n, c in _fees().items()],
        *FEE_PARTS,
    )


def revolver_months(
    hist: DataFrame, only: str | None = "Revolver", key: str = "acct_id"
) -> DataFrame:
    """Days with a behaviour flag; ``only`` None keeps all of them, NULL flags included."""
    rows = hist.filter(_revolver_rows())
    if only is not None:
        rows = rows.filter(F.col("revolver_flag") == only)
    return rows.select(key, "load_date", "revolver_flag")


def monthly_history(
    hist: DataFrame, only: str | None = "Revolver", key: str = "acct_id", check_unique: bool = True
) -> DataFrame:
    """Behaviour flag, fees and principal in one pass and one row per (account, date).

    Each is NULL where its own row filter does not hold, which is what three filtered
    left joins of the same table on account and date give when those are unique.  Two rows
    of one account and date raise unless ``check_unique`` is off.
    """
    flag = _revolver_rows()
    if only is not None:
        flag = flag & (F.col("revolver_flag") == only)
    fees = _fees_rows()
    values = {
        "revolver_flag": F.when(flag, F.col("revolver_flag")),
        **{n: F.when(fees, c) for n, c in _fees().items()},
        "principal": F.when(_month_end_flagged(), F.col("principal")),
    }
    rows = hist.filter(_not_fraud()).select(key, "load_date", *[c.alias(n) for n, c in values.items()])
    if not check_unique:
        return rows
    # the join that follows needs the same shuffle by account and date
    per_day = rows.groupBy(key, "load_date").agg(
        F.count(F.lit(1)).alias("__rows"), *[F.any_value(n).alias(n) for n in values]
    )
    twice = F.raise_error(F.lit(f"more than one history row per {key} and load_date"))
    one = F.when(F.col("__rows") == 1, F.col("load_date")).otherwise(twice)
    return per_day.withColumn("load_date", one).drop("__rows")


def net_sales(txn: DataFrame, key: str = "account_no", out_key: str = "acct_id") -> DataFrame:
    """Net merchant sales, cash advances and their sum per account and month end.

    A NULL operand drops the row from that sum only; an empty sum is 0.
    """
    zero = F.lit(0.0)
    adjustment = F.when(
        F.col("tcode") == codes.ADJUSTMENT_CODE, F.col("sales_adj") + F.col("interest_adj")
    ).otherwise(zero)
    sums = txn.groupBy(
        F.col(key).cast("string").alias(out_key), F.last_day("as_of").alias("month_end")
    ).agg(
        (
            F.coalesce(F.sum(F.when(F.col("ttype") == "Sale", F.col("net_sale"))), zero)
            - F.coalesce(F.sum(F.abs(adjustment + F.col("net_returns"))), zero)
        ).alias("net_merch_sales"),
        F.coalesce(F.sum(F.col("cash_regular") + F.col("cash_atm")), zero).alias(
            "net_cash_advance"
        ),
    )
    return sums.withColumn("net_sales", F.col("net_merch_sales") + F.col("net_cash_advance"))


def behaviour_panel(
    enriched: DataFrame,
    hist: DataFrame,
    txn: DataFrame,
    *,
    only: str | None = "Revolver",
) -> DataFrame:
    """Enriched performance rows with monthly history, sales and rates.

    History (one scan instead of three) and sales (reduced to account-months first) join
    on account and month end, which share one partitioning of the panel.  The panel must
    carry the max-MOB label already (see :func:`max_mob_indicator`).

    Periods are taken as they stand, month ends or not.
    """
    history = monthly_history(hist, only)
    monthly = history.withColumnsRenamed({"acct_id": "account_id", "load_date": "period"})
    sales = net_sales(txn).withColumnsRenamed({"acct_id": "account_id", "month_end": "period"})
    on = ["account_id", "period"]
    return (
        enriched.join(monthly, on, "left")
        .join(sales, on, "left")
        .select(
            "*",
            date_band_rate(F.col("period"), codes.OPEX_RATES, codes.OPEX_DEFAULT).alias(
                "opex_rate"
            ),
            date_band_rate(F.col("period"), codes.FUNDING_RATES, codes.FUNDING_DEFAULT).alias(
                "funding_rate"
            ),
            acquisition_cost(F.col("channel_label"), F.year("entry_date")).alias("acq_cost"),
        )
    )


def panel_keys(spec: EnrichSpec = EnrichSpec()) -> dict[str, Column]:
    """Grouping keys of the aggregate: 53 with the attributes of the default spec."""
    year, quarter, label = year_quarter(F.col("entry_date"))
    return {
        "year": year,
        "quarter": quarter,
        "year_quarter": label,
        **{f"behaviour_{c}": behaviour_label(F.col(c)) for c in spec.behaviour_codes},
        **{
            c: F.col(c)
            for c in (
                "credit_band",
                "price_segment",
                "line_segment",
                "acq_risk_tier",
                "mob_indicator",
                "credit_line",
                "status",
            )
        },
        "perf_month": F.col("period"),
        "perf_year": F.year("period"),
        **{c: F.col(c) for c in ("channel_label", "mob", "book_month")},
        **{f"{c}_tag": F.col(f"{c}_tag") for c in spec.patterns},
        **{f"{c}_flag": F.col(f"{c}_flag") for c in spec.balances},
        **{c: F.col(c) for c in spec.counts},
    }


def panel_fields(spec: EnrichSpec = EnrichSpec()) -> dict[str, Field]:
    """How the keys of :func:`panel_keys` are packed; year, quarter and label follow from one number."""
    bands = Label((*[b.label for b in codes.CREDIT_BANDS], codes.CREDIT_BANDS_DEFAULT))
    arms = {c: Label(tuple(f"{arm} {c}" for arm in ("1.L", "2.H", "3.BAU"))) for c in ("Pricing", "Line")}
    return {
        **{f"behaviour_{c}": BEHAVIOURS for c in spec.behaviour_codes},
        "credit_band": bands,
        "price_segment": arms["Pricing"],
        "line_segment": arms["Line"],
        "acq_risk_tier": Code(),
        "mob_indicator": Label(("Max MOB < 24", "Max MOB >= 24")),
        "status": Code(),
        "perf_month": Day(),
        "channel_label": Label((*codes.PANEL_CHANNELS.values(), codes.PANEL_CHANNEL_DEFAULT)),
        "mob": Number(16, -10_000),
        "book_month": Day(),
        **{f"{c}_tag": BEHAVIOURS for c in spec.patterns},
        **{f"{c}_flag": FLAG for c in spec.balances},
        **{c: Number(20, -1_000, "bigint") for c in spec.counts},
    }


def panel_measures() -> dict[str, Column]:
    """The 37 measures of the aggregate, by form."""
    has_id = F.col("account_id").isNotNull()
    not_z = ~F.col("status").isin("Z") & has_id
    not_c = ~F.col("status").isin("C") & has_id
    live = ~F.col("status").isin("Z", "C") & has_id
    revolving = F.col("revolver_flag").isNotNull()
    charged = F.col("charge_off") == 1
    late = F.col("dpd30") == 1
    zed = F.col("status") == "Z"
    closed_now = F.last_day("closure_date") == F.col("period")
    balance, principal = F.col("balance"), F.col("principal")
    monthly_apr = F.col("merch_apr") / F.lit(100) / F.lit(12)

    counts = {
        "rvl_unit": revolving,
        "tot_unit": has_id,
        "tot_nz_unit": not_z,
        "tot_unit_open": not_c,
        "dpd30_unit": late,
        "co_unit": zed,
        "new_co_unit": charged,
        "closure_unit": F.col("closure_flag") == 1,
        "cur_closure_unit": closed_now,
    }
    sums_where = {
        "tot_rvl_dollar": (has_id & revolving, balance),
        "tot_dollar": (has_id, balance),
        "cost_per_acct": (F.col("mob") == 0, F.col("acq_cost")),
        "dpd30_dollar": (late, balance),
        "co_dollar": (zed, balance),
        "new_co_dollar": (charged, balance),
        "new_net_co_dollar": (charged, balance * F.lit(codes.NET_CHARGEOFF_SHARE)),
        "opex_amt": (live, balance * F.col("opex_rate")),
        "funding_amt": (live, balance * F.col("funding_rate")),
        "tot_nz_dollar": (not_z, balance),
        "tot_prin_dollar": (has_id, principal),
        "tot_line": (not_c, F.col("credit_line")),
        "tot_acq_line": (not_c, F.col("acq_line")),
        "int_prin_sum": (not_z, monthly_apr * principal),
        "new_co_prin_dollar": (charged, principal),
        "new_net_co_prin_dollar": (charged, principal * F.lit(codes.NET_CHARGEOFF_SHARE)),
        "int_bal_sum": (not_z, monthly_apr * balance),
    }
    interchange = F.lit(codes.INTERCHANGE_RATE)
    sums = {
        "interest_amt": F.col("monthly_interest"),
        "gross_sale": F.col("gross_sales"),
        "late_fee": F.col("net_late_fee"),
        "other_fee": F.col("net_other_fee"),
        "monthly_fee": F.col("monthly_fee"),
        "annual_fee": F.col("net_annual_fee"),
        "net_sales": F.col("net_sales"),
        "interchange_net_sales": F.col("net_sales") * interchange,
        "interchange_net_merch_sales": F.col("net_merch_sales") * interchange,
        "interchange_gross_sales": F.col("gross_sales") * interchange,
        "tot_apr": F.col("merch_apr"),
    }
    return {
        **{n: F.sum(F.when(c, 1).otherwise(0)).cast("bigint") for n, c in counts.items()},
        **{n: F.sum(F.when(c, v).otherwise(F.lit(0.0))) for n, (c, v) in sums_where.items()},
        **{n: F.sum(v) for n, v in sums.items()},
    }


_QUARTERS = ("year", "quarter", "year_quarter")
_ENTERED = "__entered"  # four times the year, and the quarter from 0


def _derived(name: str) -> Column:
    """A key that follows from another one."""
    entered = F.col(_ENTERED)
    year, quarter = F.floor(entered / 4).cast("int"), (entered % 4 + 1).cast("int")
    return {
        "year": year,
        "quarter": quarter,
        "year_quarter": F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")),
        "perf_year": F.year("perf_month"),
    }[name]


def behaviour_aggregate(
    panel: DataFrame,
    keys: Mapping[str, Column] | None = None,
    measures: Mapping[str, Column] | None = None,
    order_by: Sequence[str] = (),
    *,
    fields: Mapping[str, Field] | None = None,
) -> DataFrame:
    """Sums of ``measures`` per combination of ``keys``, in the order of ``order_by`` if any.

    Without ``keys``, those of :func:`panel_keys`, grouped in packed form: ten integers (11 of a ``keyed`` panel) and the
    credit line instead of 53 columns, half of them texts.  A ``keyed`` panel brings those of its
    reports and applications with it (see :func:`enrich_performance`).  ``fields`` packs keys of your own;
    keys without a field are grouped as they are.
    """
    spec = EnrichSpec()
    measures = panel_measures() if measures is None else measures
    sums = [c.alias(n) for n, c in measures.items()]
    grouped, derived = dict(panel_keys() if keys is None else keys), []
    names = list(grouped)
    if keys is None:
        fields = panel_fields() if fields is None else dict(fields)
        derived = [*_QUARTERS, "perf_year"]
        grouped = {n: c for n, c in grouped.items() if n not in derived}
        grouped[_ENTERED] = F.year("entry_date") * 4 + F.quarter("entry_date") - 1
        fields[_ENTERED] = Number(16)
    brought = []
    if keys is None:
        brought = [p for p in (report_packing(spec), *key_packings(spec)) if set(p.names) <= set(panel.columns)]
    grouped = {n: c for n, c in grouped.items() if not any(n in p.fields for p in brought)}
    packing = Packing({n: f for n, f in (fields or {}).items() if n in grouped})
    plain = {n: c for n, c in grouped.items() if n not in packing.fields}
    if packing.fields:
        panel = panel.select("*", *[grouped[n].alias(f"__key_{n}") for n in packing.fields])
        panel = panel.select("*", *packing.columns("__key_{}"))
    words = [n for p in (packing, *brought) for n in p.names]
    out = panel.groupBy(*words, *[c.alias(n) for n, c in plain.items()]).agg(*sums)
    if words:
        out = out.select(*[c for p in (packing, *brought) for c in p.unfolded()], *plain, *measures)
    out = out.select(*[_derived(n).alias(n) if n in derived else F.col(f"`{n}`") for n in names], *measures)
    return out.orderBy(*order_by) if order_by else out


def cohort_slices(
    rows: DataFrame,
    mobs: Sequence[int] = codes.COHORT_MOBS,
    years: Sequence[int] = codes.COHORT_YEARS,
    *,
    mob: str = "mob",
    entered: str = "entry_date",
) -> DataFrame:
    """Rows of each (MOB, vintage year) cohort, labelled ``cohort``, all slices in one pass."""
    year = F.year(entered)
    label = F.concat(F.lit("m"), F.col(mob).cast("string"), F.lit("_"), year.cast("string"))
    return rows.filter(F.col(mob).isin(*mobs) & year.isin(*years)).withColumn("cohort", label)


def model_extract(
    panel: DataFrame,
    spec: EnrichSpec = EnrichSpec(),
    mobs: Sequence[int] = codes.EXTRACT_MOBS,
    min_year: int = codes.EXTRACT_MIN_YEAR,
) -> DataFrame:
    """Account rows at the extract MOBs with 0/1 label and all features."""
    year = F.year("entry_date")
    return panel.filter(F.col("mob").isin(*mobs) & (year >= min_year)).select(
        "account_id",
        "app_id",
        "entry_date",
        year.alias("vintage_year"),
        "mob",
        "period",
        "revolver_flag",
        F.when(F.col("revolver_flag") == "Revolver", 1).otherwise(0).alias("is_revolver"),
        *[behaviour_label(F.col(c)).alias(f"behaviour_{c}") for c in spec.behaviour_codes],
        *spec.patterns,
        *[f"{c}_tag" for c in spec.patterns],
        *[f"{c}_flag" for c in spec.balances],
        *spec.counts,
    )
