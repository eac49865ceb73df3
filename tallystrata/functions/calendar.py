"""Calendar parts and ages. Every age takes its reference date explicitly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def year(col: Column) -> Column:
    return F.year(col)


def month(col: Column) -> Column:
    return F.month(col)


def quarter(col: Column) -> Column:
    return F.quarter(col)


def weekday(col: Column) -> Column:
    """Monday is 0."""
    return F.weekday(col)


def day(col: Column) -> Column:
    return F.to_date(col)


def month_start(col: Column) -> Column:
    return F.trunc(F.to_date(col), "MM")


def iso_date(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def date_literal(value: str) -> Column:
    return F.lit(value).cast("date")


def decimal_age(birth: Column, as_of: str) -> Column:
    """Days over 365.25, rounded half-even to one place; the rounding precedes any banding."""
    return F.bround(F.datediff(date_literal(as_of), birth) / F.lit(365.25), 1)


def completed_years(birth: Column, as_of: str) -> Column:
    """Calendar years completed; someone born on 29 February completes a year on 1 March of common years."""
    ref = date_literal(as_of)
    month_day = lambda c: F.month(c) * 100 + F.dayofmonth(c)
    return F.year(ref) - F.year(birth) - (month_day(ref) < month_day(birth)).cast("int")
