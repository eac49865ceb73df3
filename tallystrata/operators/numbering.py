"""Dense 0-based positions for dimensions: by sorted key, or by frequency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import stored

# Up to here one task may sort the whole dimension; a larger one is numbered range by range.
SINGLE_TASK_ROWS = 20_000


def at_most(df: DataFrame, rows: int) -> bool:
    """Size check that reads partitions only until ``rows`` + 1 rows are found (``isEmpty`` would start every task)."""
    return not df.select(F.lit(1)).offset(rows).limit(1).collect()


def number_rows(
    df: DataFrame, order: Sequence[Column], out: str, single_task_rows: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """Adds ``out`` = 0, 1, 2, ... in a total order. Reads ``df`` once to check its size, so give a stored table."""
    if at_most(df, single_task_rows):
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)) - 1)
    return _number_by_ranges(df, order, out)


def _number_by_ranges(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    # monotonically_increasing_id = (partition << 33) + position; stored, so that both uses below see the same ids
    ranged = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
    )
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    position = F.col("_start") + F.col("_id") - F.shiftleft("_part", 33)
    return (
        ranged.join(F.broadcast(starts), "_part")
        .withColumn(out, position.cast("int"))
        .drop("_id", "_part", "_start")
    )


def dense_index(dimension: DataFrame, key: str, out: str, **limits) -> DataFrame:
    """Position of each key in ascending order."""
    return number_rows(dimension, [F.col(key).asc_nulls_last()], out, **limits)


def frequency_index(counts: DataFrame, key: str, count: str, out: str, **limits) -> DataFrame:
    """Position by count, largest first; equal counts are ordered by name. Null names get no position."""
    named = stored(counts.filter(F.col(key).isNotNull()))
    return number_rows(named, [F.col(count).desc(), F.col(key).asc()], out, **limits)
