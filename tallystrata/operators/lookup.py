"""Equi-join lookups that stay balanced when a key is hot, and key-integrity checks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .numbering import at_most

# At most HOT_LIMIT keys can hold 1/HOT_LIMIT of the rows each, so the list of hot keys is small whatever the input size.
HOT_LIMIT = 4096
SKETCH_ITEMS = 16_384
SKETCH_GROUPS = 16
SMALL_ROWS = 20_000


@dataclass(frozen=True)
class HotKeys:
    """Keys to cut, with the number of slices of each; ``null_slices`` is the same for rows without a key."""

    slices: list[tuple[object, int]]
    null_slices: int

    @property
    def balanced(self) -> bool:
        return not self.slices and self.null_slices <= 1


@dataclass(frozen=True)
class KeyCounts:
    """Rows of a column, those with a key, and the counts of its frequent keys, from bounded sketches.

    The choice of slices depends on the sketches, never a result.
    """

    rows: int
    keyed: int
    frequent: tuple[tuple[object, int], ...]

    def hot(self, slices: int) -> HotKeys:
        """Keys whose rows would exceed one of ``slices`` even partitions, and at least 1/HOT_LIMIT of all rows."""
        if not self.rows:
            return HotKeys([], 0)
        parts = min(HOT_LIMIT, max(slices, 1))
        share = lambda n: math.ceil(n * slices / self.rows)
        hot = [(k, share(n)) for k, n in sorted(self.frequent, key=lambda c: -c[1]) if n * parts > self.rows]
        return HotKeys(hot[:HOT_LIMIT], share(self.rows - self.keyed))


def frequent_keys(key: str) -> Column:
    """Aggregate of a bounded sketch: the most frequent keys of a column, as a write can observe them."""
    return F.expr(f"approx_top_k(`{key}`, {HOT_LIMIT}, {SKETCH_ITEMS})")


def key_counts(df: DataFrame, key: str, slices: int) -> KeyCounts:
    """One pass over the key column. Input partitions are dealt into groups, so no task merges the sketches of all others,
    and each group reports only its frequent keys."""
    parts = min(HOT_LIMIT, max(slices, 1))
    sketched = (
        df.select(F.col(key).alias("k"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g"))
        .groupBy("g").agg(frequent_keys("k").alias("top"), F.count(F.lit(1)).alias("total"), F.count("k").alias("keyed"))
    )
    frequent = lambda t: t["item"].isNotNull() & (t["count"] * (2 * parts) > F.col("total"))
    # at most SKETCH_GROUPS rows with a bounded list each
    groups = sketched.select("total", "keyed", F.filter("top", frequent).alias("top")).collect()
    counts: dict[object, int] = {}
    for item in (t for g in groups for t in g.top):
        counts[item["item"]] = counts.get(item["item"], 0) + item["count"]
    return KeyCounts(sum(g.total for g in groups), sum(g.keyed for g in groups), tuple(counts.items()))


def hot_keys(df: DataFrame, key: str, slices: int) -> HotKeys:
    return key_counts(df, key, slices).hot(slices)


@dataclass(frozen=True)
class Known:
    """What the writes of some tables observed: their rows, and the key counts of their columns.

    With it a lookup is planned without looking at any row.
    """

    rows: Mapping[str, int] = field(default_factory=dict)
    keys: Mapping[tuple[str, str], KeyCounts] = field(default_factory=dict)

    def about(self, right: str, left: tuple[str, str]) -> dict[str, object]:
        """Arguments of :func:`spread_lookup` for a lookup table and the column that is looked up."""
        return {"right_rows": self.rows.get(right), "counts": self.keys.get(left)}


def spread_lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "left",
    sized_by: DataFrame | None = None,
    detect_in: DataFrame | None = None,
    slices: int | None = None,
    small_rows: int = SMALL_ROWS,
    *,
    right_rows: int | None = None,
    counts: KeyCounts | None = None,
) -> DataFrame:
    """Join on ``key`` that stays balanced. Same result as ``left.join(right, key, how)`` for ``how`` in left, inner.

    A ``right`` of at most ``small_rows`` rows is broadcast. Otherwise hot keys of ``left`` are cut into slices, picked
    by the hash of the ``spread_by`` columns (a recomputed task sends each row to the same place), and the matching
    ``right`` rows are repeated per slice; null keys match nothing and are spread as well. Without hot keys this is
    the plain join. ``sized_by`` and ``detect_in`` stand in for ``right`` and ``left`` where these are costly to
    compute twice: a table with at least as many rows, and one with similar key frequencies. Where ``right_rows`` (or more)
    and ``counts`` are known, no job is needed to plan the join. ``slices`` defaults to the session's shuffle partitions.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    columns = [*left.columns, *[c for c in right.columns if c != key]]
    if right_rows <= small_rows if right_rows is not None else at_most(right if sized_by is None else sized_by, small_rows):
        return left.join(F.broadcast(right), key, how).select(*columns)
    spark = left.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions")) if slices is None else slices
    hot = counts.hot(slices) if counts is not None else hot_keys(left if detect_in is None else detect_in, key, slices)
    if hot.balanced:
        return left.join(right, key, how).select(*columns)

    schema = T.StructType([T.StructField(key, left.schema[key].dataType), T.StructField("_slices", T.IntegerType())])
    # at most HOT_LIMIT rows
    whole = isinstance(schema[key].dataType, T.IntegralType)
    cuts = F.broadcast(spark.createDataFrame([(int(k) if whole else k, n) for k, n in hot.slices], schema))
    row_hash = F.xxhash64(*spread_by)
    count = F.when(F.col(key).isNull(), F.lit(max(hot.null_slices, 1))).otherwise(F.coalesce("_slices", F.lit(1)))
    cut = left.join(cuts, key, "left").withColumn("_slice", F.pmod(row_hash, count).cast("int"))
    repeated = (
        right.filter(F.col(key).isNotNull()).join(cuts, key, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
    )
    return cut.drop("_slices").join(repeated.drop("_slices"), [key, "_slice"], how).select(*columns)


def null_matching_lookup(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """Left join in which a null key matches a null key, as dataframe libraries merge.

    The key is matched as text in which null has its own value, so a frequent null is sliced like any hot key.
    """
    matched = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null")).alias("_match")
    others = right.select(matched, *[c for c in right.columns if c != key])
    return spread_lookup(left.select("*", matched), others, "_match", spread_by).drop("_match")


def orphan_rows(child: DataFrame, child_key: Column, parent: DataFrame, parent_key: Column) -> DataFrame:
    """One row ``orphans``: child rows whose non-null key has no parent. Child keys are counted before the join."""
    keys = (
        child.select(child_key.alias("_key")).filter("_key is not null")
        .groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    )
    # both groupings shuffle by the join key; an anti join would be pushed below them, back onto the rows
    parents = parent.select(parent_key.alias("_key")).distinct().withColumn("_known", F.lit(True))
    return keys.join(parents, "_key", "left").filter("_known is null").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("orphans")
    )
