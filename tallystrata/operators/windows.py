"""Share of total, running sum, change from the previous row, top-k: all on grouped output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import half_up, percent, ratio


def share_of_total(
    grouped: DataFrame, count: str, out: str, places: int = 2, counted: DataFrame | None = None
) -> DataFrame:
    """100 * count / sum(count); the total is a scalar subquery, so the groups stay distributed.

    ``counted`` is the frame whose rows the counts stand for: counting it directly reads no column of a Parquet table.
    """
    totals = grouped.agg(F.sum(count).alias("total")) if counted is None else counted.agg(F.count(F.lit(1)).alias("total"))
    total = totals.scalar()
    share = ratio(percent(F.col(count)).cast("decimal(20,0)"), total.cast("decimal(16,0)"))
    return grouped.withColumn(out, half_up(share, places).cast("double"))


def top_k(df: DataFrame, by: Column, tie: Sequence[str], k: int) -> DataFrame:
    """Largest ``k`` rows, nulls first; ties are settled by ``tie`` so that the result does not depend on row order."""
    return df.orderBy(by.desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tie]).limit(k)


def running_sum(calendar_rows: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Running total in a default RANGE frame: equal order values share it. One row per calendar period expected."""
    frame = Window.orderBy(F.col(order).asc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return calendar_rows.withColumn(out, F.sum(value).over(frame))


def running_compound(calendar_rows: DataFrame, order: str, rate: str, out: str) -> DataFrame:
    """Compounded variant of :func:`running_sum` for fractional rates."""
    frame = Window.orderBy(F.col(order).asc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    growth = F.sum(F.log1p(F.col(rate).cast("double"))).over(frame)
    return calendar_rows.withColumn(out, F.expm1(growth))


def previous_value(calendar_rows: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Value of the row before; a missing period is not detected. One row per calendar period expected."""
    return calendar_rows.withColumn(out, F.lag(value).over(Window.orderBy(F.col(order).asc())))
