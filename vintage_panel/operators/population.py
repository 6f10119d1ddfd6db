"""One row per application, booked and inside the date window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import vintage_month
from ..sources.io import in_window


def _one_per_key(df: DataFrame, keys: Sequence[str], ordering: list) -> DataFrame:
    # Filtering on row_number() = 1 lets Spark keep one row per key on the map side
    # (WindowGroupLimit), so a key with many rows does not reach one task whole.
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return (
        df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key by ``order``; ``tie`` columns (highest first) make it repeatable."""
    return _one_per_key(df, keys, [F.desc(order), *[F.desc(c) for c in tie]])


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Earliest row per key by ``order``; ``tie`` columns (lowest first) make it repeatable."""
    return _one_per_key(df, keys, [F.asc(order), *[F.asc(c) for c in tie]])


@dataclass(frozen=True)
class PopulationSpec:
    """Columns and window of a population; ``columns`` None keeps all columns."""

    external_id: str = "ext_id"
    created: str = "created"
    account_id: str = "account_id"
    tie: tuple[str, ...] = ("app_id",)
    start: date | None = date(2022, 1, 1)
    end: date | None = date(2024, 3, 31)
    columns: tuple[str, ...] | None = None


def population(apps: DataFrame, spec: PopulationSpec = PopulationSpec()) -> DataFrame:
    """Newest application per external id, then booked ones inside [start, end).

    The order matters: an external id whose newest application is not booked or lies
    outside the window is lost, an older application does not take its place.
    """
    keep = list(spec.columns or apps.columns)
    needed = dict.fromkeys([*keep, spec.external_id, spec.created, spec.account_id, *spec.tie])
    newest = latest_per_key(apps.select(*needed), [spec.external_id], spec.created, spec.tie)
    return newest.filter(
        F.col(spec.account_id).isNotNull() & in_window(F.col(spec.created), spec.start, spec.end)
    ).select(*keep, vintage_month(F.col(spec.created)).alias("vintage_month"))
