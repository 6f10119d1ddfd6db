"""The three end-to-end builds: target, balances, behaviour."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import event_mob
from ..operators.behaviour import (
    EnrichSpec,
    behaviour_aggregate,
    behaviour_panel,
    enrich_performance,
    entered,
    max_mob_indicator,
    model_extract,
    unpacked,
)
from ..operators.lookups import disputed_accounts, with_suffix_key
from ..operators.panel import delinquency_panel, wide_panel
from ..operators.population import PopulationSpec, population
from ..operators.profile import profile
from ..operators.rules import (
    RuleColumns,
    apply_rules,
    exclude,
    exclusion_rules,
    flag_names,
)
from ..operators.skew import hot_keys, lookup_join
from ..operators.target import account_lookups, model_target, with_target_flags


@dataclass(frozen=True)
class TargetSpec:
    population: PopulationSpec = field(default_factory=PopulationSpec)
    rules: RuleColumns = field(default_factory=RuleColumns)
    horizon: int = 24
    open_date_from: str = "end"
    check_unique: bool = True


def build_target(
    apps: DataFrame,
    hist: DataFrame,
    shifts: DataFrame,
    cases: DataFrame,
    mislabeled: DataFrame,
    portfolio: DataFrame,
    spec: TargetSpec = TargetSpec(),
    hot: DataFrame | tuple | None = None,
) -> DataFrame:
    """Population with exclusion flags, monthly bad flags and the model target.

    ``hist`` and ``shifts`` are keyed by ``acct_id``.  Every source is scanned once for
    its account-level facts; the population meets all of them in a single join.
    """
    key = spec.population.account_id
    pop = population(apps, spec.population)
    panel = delinquency_panel(portfolio, key=key)
    lookups = account_lookups(
        pop,
        key=key,
        hist=hist.withColumnRenamed("acct_id", key),
        panel=panel,
        shifts=shifts.withColumnRenamed("acct_id", key),
        disputed=disputed_accounts(cases, mislabeled, key="account_id").withColumnRenamed(
            "account_id", key
        ),
        hi=spec.horizon,
        open_date_from=spec.open_date_from,
        check_unique=spec.check_unique,
    )
    # counted on the raw table: one column, and no second run of the de-duplication
    joined = lookup_join(pop, lookups, key, hot=hot_keys(apps, key) if hot is None else hot)
    rules = exclusion_rules(spec.rules)
    flagged = apply_rules(joined, rules)
    keep = [*pop.columns, *flag_names(rules), "global_exclusion"]
    return model_target(with_target_flags(flagged, keep, spec.horizon), key, spec.horizon)


def credit_event(family: tuple[str, str, str] = ("chargeoff", "settlement", "workout")) -> Column:
    """MOB of the credit event that ends the balance observation."""
    return event_mob(*[F.col(f"first_{n}_mob") for n in family])


def build_balances(
    target: DataFrame,
    master: DataFrame,
    *,
    key: str = "account_id",
    full_key: str = "full_acct",
    as_of: str = "as_of",
    balance: str = "balance",
    hi: int = 24,
    hot: DataFrame | tuple | None = None,
) -> DataFrame:
    """Kept accounts with monthly balances, missing flags and the balance at the event."""
    return wide_panel(
        exclude(target),
        with_suffix_key(master, full_key, key),
        key=key,
        start="book_vintage",
        as_of=as_of,
        value=balance,
        prefix="balance_t",
        hi=hi,
        missing=True,
        event=credit_event(),
        event_name="event_balance",
        hot=hot,
    )


def build_profile(
    balances: DataFrame,
    apps: DataFrame,
    scores: DataFrame,
    perf: DataFrame,
    *,
    key: str = "account_id",
    hi: int = 24,
    hot: DataFrame | tuple | None = None,
) -> DataFrame:
    """Balances with profile columns, monthly credit lines and the line at the event."""
    profiled = profile(balances.drop("channels"), apps, scores, key=key, hot=hot)
    return wide_panel(
        profiled,
        perf,
        key=key,
        snap_key="account_id",
        start="book_vintage",
        as_of="period",
        value="credit_line",
        prefix="credit_line_t",
        hi=hi,
        event=credit_event(),
        event_name="event_credit_line",
        hot=hot,
    )


def build_panel(
    perf: DataFrame,
    apps: DataFrame,
    bureau: DataFrame,
    hist: DataFrame,
    txn: DataFrame,
    spec: EnrichSpec = EnrichSpec(),
    only: str | None = "Revolver",
    hot_accounts: DataFrame | tuple | None = None,
    hot_apps: DataFrame | tuple | None = None,
    keyed: bool = False,
) -> DataFrame:
    """Account-by-month behaviour panel; ``keyed`` for an aggregate over all its keys.

    Pass :data:`NO_HOT_KEYS` where ``perf`` is known to hold one row per account and month.
    """
    rows = entered(perf, spec)
    labelled = max_mob_indicator(rows, hot=hot_accounts)
    if hot_apps is None:
        hot_apps = hot_keys(rows, "app_id")
    enriched = enrich_performance(labelled, apps, bureau, spec, hot=hot_apps, packed=True, keyed=keyed)
    return unpacked(behaviour_panel(enriched, hist, txn, only=only), spec, keyed)


def build_behaviour(
    perf: DataFrame,
    apps: DataFrame,
    bureau: DataFrame,
    hist: DataFrame,
    txn: DataFrame,
    spec: EnrichSpec = EnrichSpec(),
    keys: Mapping[str, Column] | None = None,
    measures: Mapping[str, Column] | None = None,
    **hot: Sequence,
) -> DataFrame:
    """Behaviour panel summed over ``keys`` (default: all)."""
    panel = build_panel(perf, apps, bureau, hist, txn, spec, keyed=keys is None and spec == EnrichSpec(), **hot)
    return behaviour_aggregate(panel, keys, measures)


def build_extract(
    perf: DataFrame,
    apps: DataFrame,
    bureau: DataFrame,
    hist: DataFrame,
    txn: DataFrame,
    spec: EnrichSpec,
    **hot: Sequence,
) -> DataFrame:
    """Modelling rows: behaviour flags of every value, a few MOBs, all features."""
    panel = build_panel(perf, apps, bureau, hist, txn, spec, only=None, **hot)
    return model_extract(panel, spec)
