"""Exact sums and means, the two rounding rules and guarded division."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

from .casting import MONEY

RATE = "decimal(18,8)"


def half_up(col: Column, places: int) -> Column:
    return F.round(col, places)


def half_even(col: Column, places: int) -> Column:
    return F.bround(col, places)


def as_double(col: Column) -> Column:
    # adding 0 turns -0.0 into 0.0
    return col.cast("double") + F.lit(0.0)


def money_sum(col: Column) -> Column:
    """Decimal sum, independent of row order; all-null groups give 0."""
    return F.coalesce(F.sum(col.cast(MONEY)), F.lit(0).cast(MONEY))


def amount(df: DataFrame, name: str) -> Column:
    """A column to be summed exactly: a decimal as it is, anything else as a plain amount."""
    exact = isinstance(df.schema[name].dataType, DecimalType)
    return F.col(name) if exact else F.col(name).cast(MONEY)


def exact_sum(col: Column) -> Column:
    """Sum of decimals in a type that ten more digits widen; all-null groups give 0."""
    return F.coalesce(F.sum(col), F.lit(0))


def exact_mean(col: Column) -> Column:
    return F.try_divide(F.sum(col), F.count(col).cast("decimal(20,0)"))


def mean_of(total: Column, count: Column) -> Column:
    """Exact decimal quotient, null for an empty group."""
    return F.try_divide(total.cast("decimal(24,2)"), count.cast("decimal(20,0)"))


def money_mean(col: Column) -> Column:
    return mean_of(F.sum(col.cast(MONEY)), F.count(col))


def int_mean(col: Column) -> Column:
    return mean_of(F.sum(col.cast("bigint")), F.count(col))


def exact_rate(col: Column) -> Column:
    """Rate as decimal, so that sums do not depend on row order; out of range gives null."""
    return col.try_cast(RATE)


def rate_mean(col: Column) -> Column:
    rate = exact_rate(col)
    return F.try_divide(F.sum(rate), F.count(rate).cast("decimal(16,0)"))


def percent(col: Column) -> Column:
    return col * 100


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is 0 or null."""
    return F.try_divide(numerator, denominator)
