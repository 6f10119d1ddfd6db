"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_index(c: Column) -> Column:
    """Months since year 0; equal for all days of one calendar month."""
    return F.year(c) * 12 + F.month(c)


def month_diff(later: Column, earlier: Column) -> Column:
    """Number of calendar-month boundaries between two dates (may be negative).

    ``months_between`` and ``timestampdiff`` count elapsed months and would give
    0 for 31 January -> 1 February, where the boundary count is 1.
    """
    return month_index(later) - month_index(earlier)


def is_month_end(c: Column) -> Column:
    return c == F.last_day(c)


def month_end_after(c: Column, months: int) -> Column:
    return F.last_day(F.add_months(c, months))


def vintage_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def book_vintage(c: Column) -> Column:
    return F.last_day(c)


def year_quarter(c: Column) -> tuple[Column, Column, Column]:
    """Year, quarter and the ``2024Q3`` label of a date."""
    year, quarter = F.year(c), F.quarter(c)
    return year, quarter, F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string"))
