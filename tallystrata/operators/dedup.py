"""Deduplication with a stated survivor.

``row_number() = 1`` is planned with a group limit before the exchange, so a key that repeats many times (the null
key included) leaves one row per map task and never gathers in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import stored

#: Repeated keys that travel to all tasks.
FEW_KEYS = 20_000


def _best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``; rows with a null key count as one group."""
    return _best(df, keys, [F.col(c).asc_nulls_last() for c in order])


def keep_first_of_few(df: DataFrame, key: str, order: Sequence[str], few: int = FEW_KEYS) -> DataFrame:
    """The rows of ``keep_first``, for wide rows whose key seldom repeats: only keys are exchanged to find those that do.

    Runs a job for that and reads ``df`` again, so its input has to be stored. Rows of other keys stay where they are; with
    more than ``few`` repeated keys all rows are ranked as in ``keep_first``.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    repeated = stored(counted.select(F.col(key).alias("_key")), "repeated")
    found = repeated.limit(few + 1).count()
    if not found:
        return df
    if found > few:
        return keep_first(df, [key], order)
    same, small = F.col(key).eqNullSafe(F.col("_key")), F.broadcast(repeated)
    return df.join(small, same, "left_anti").unionByName(keep_first(df.join(small, same, "left_semi"), [key], order))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _best(df, keys, [F.col(c).desc_nulls_last() for c in order])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
