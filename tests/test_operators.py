import math
import random

import pytest
from pyspark.sql import functions as F

from tallystrata.operators import dedup, lookup, numbering, stats, windows


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- dedup

def test_first_and_last_row_per_key(rows):
    df = rows("k int, v string, pos int", (1, "b", 2), (1, "a", 1), (2, "c", 3), (None, "d", 4), (None, "e", 5))
    assert tuples(dedup.keep_first(df, ["k"], ["pos"]).select("k", "v")) == [(1, "a"), (2, "c"), (None, "d")]
    assert tuples(dedup.keep_last(df, ["k"], ["pos"]).select("k", "v")) == [(1, "b"), (2, "c"), (None, "e")]


def test_dedup_reduces_before_the_exchange(rows):
    df = rows("k int, v string, pos int", (1, "b", 2))
    plan = dedup.keep_first(df, ["k"], ["pos"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("few", [0, 1, 2, 20_000])
def test_first_of_few_equals_first(rows, few):
    data = [(k, i % 4, i) for i, k in enumerate([1, 2, None, 3, 1, 4, None, 5, 1, 6, 7])]
    df = rows("k int, v int, pos int", *data)
    want = tuples(dedup.keep_first(df, ["k"], ["pos"]))
    assert tuples(dedup.keep_first_of_few(df, "k", ["pos"], few)) == want
    assert tuples(dedup.keep_first_of_few(df.filter("pos = 2"), "k", ["pos"], few)) == [(None, 2, 2)]


def test_rows_stay_where_no_key_repeats(rows):
    df = rows("k int, v string, pos int", (1, "b", 2), (2, "a", 1), (None, "c", 3))
    plan = dedup.keep_first_of_few(df, "k", ["pos"])._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_distinct_rows(rows):
    df = rows("a int, b int", (1, 2), (1, 2), (1, None), (1, None))
    assert tuples(dedup.distinct_rows(df)) == [(1, 2), (1, None)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_survivor_does_not_depend_on_partitions(rows, seed):
    rng = random.Random(seed)
    data = [(rng.randrange(5), rng.randrange(3), i) for i in range(200)]
    rng.shuffle(data)
    df = rows("k int, v int, pos int", *data)
    want = tuples(dedup.keep_first(df.coalesce(1), ["k"], ["pos"]))
    assert tuples(dedup.keep_first(df.repartition(7), ["k"], ["pos"])) == want


# --- lookups

def brute(left, right, how):
    found = dict()
    for k, v in right:
        found.setdefault(k, []).append(v)
    result = []
    for k, i in left:
        matches = found.get(k, []) if k is not None else []
        result += [(k, i, v) for v in matches] or ([(k, i, None)] if how == "left" else [])
    return sorted(result, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("slices, small_rows", [(1, 0), (5, 0), (64, 0), (64, 1000)])
def test_spread_lookup_equals_plain_join(rows, how, slices, small_rows):
    rng = random.Random(slices)
    left = [(rng.choice([1] * 40 + [None] * 20 + list(range(2, 30))), i) for i in range(400)]
    right = [(k, f"v{k}") for k in range(1, 20)] + [(1, "again"), (None, "never")]
    got = lookup.spread_lookup(
        rows("k int, i int", *left), rows("k int, v string", *right), "k", ["i"], how, slices=slices,
        small_rows=small_rows,
    )
    assert got.columns == ["k", "i", "v"]
    assert tuples(got) == brute(left, right, how)


def test_hot_keys_are_found_and_sliced_by_share(rows):
    df = rows("k string", *[("hot",)] * 600, *[(None,)] * 300, *[(f"k{i}",) for i in range(900)])
    hot = lookup.hot_keys(df, "k", 100)
    assert dict(hot.slices).keys() == {"hot"}
    assert 33 <= dict(hot.slices)["hot"] <= 36 and 16 <= hot.null_slices <= 18


def test_even_keys_use_the_plain_join(rows):
    df = rows("k int, i int", *[(i, i) for i in range(100)])
    assert lookup.hot_keys(df, "k", 8).balanced
    plan = lambda small: lookup.spread_lookup(
        df, rows("k int, v int", (1, 1)), "k", ["i"], slices=8, small_rows=small)._jdf.queryExecution().toString()
    assert "_slice" not in plan(0) and "SortMergeJoin" in plan(0) and "BroadcastHashJoin" in plan(1)


def test_hot_rows_spread_over_tasks(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(2000).select(F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).cast("int").alias("k"), "id")
        joined = lookup.spread_lookup(df, rows("k int, v int", (1, 1)), "k", ["id"], slices=64, small_rows=0)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 8 and max(sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_left_side(rows):
    got = lookup.spread_lookup(rows("k int, i int"), rows("k int, v int", (1, 1)), "k", ["i"], small_rows=0)
    assert got.collect() == []


def test_unknown_join_kind(rows):
    with pytest.raises(ValueError):
        lookup.spread_lookup(rows("k int", (1,)), rows("k int", (1,)), "k", ["k"], how="full")


def test_null_keys_match_only_on_request(rows):
    left, right = rows("k int", (1,), (None,)), rows("k int, v string", (1, "a"), (None, "n"))
    assert tuples(left.join(right, "k", "left")) == [(1, "a"), (None, None)]
    assert tuples(lookup.null_matching_lookup(left, right, "k", ["k"])) == [(1, "a"), (None, "n")]


def test_orphans_ignore_null_keys(rows):
    child, parent = rows("c int", (1,), (2,), (2,), (None,)), rows("p int", (1,), (3,))
    assert lookup.orphan_rows(child, F.col("c"), parent, F.col("p")).first().orphans == 2
    assert lookup.orphan_rows(child.filter("c = 1"), F.col("c"), parent, F.col("p")).first().orphans == 0


def test_orphans_are_counted_before_the_join(rows):
    child, parent = rows("c int", (1,)), rows("p int", (1,))
    plan = lookup.orphan_rows(child, F.col("c"), parent, F.col("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate [_key")


# --- numbering

@pytest.mark.parametrize("rows_in, limit, small", [(5, 5, True), (6, 5, False), (0, 0, True)])
def test_size_check(spark, rows_in, limit, small):
    assert numbering.at_most(spark.range(rows_in), limit) is small



@pytest.mark.parametrize("limit", [1000, 3])
def test_dense_index(rows, limit):
    df = rows("k string", *[(f"n{i:03}",) for i in random.Random(7).sample(range(200), 200)])
    got = numbering.dense_index(df, "k", "ix", single_task_rows=limit)
    assert sorted((r.k, r.ix) for r in got.collect()) == [(f"n{i:03}", i) for i in range(200)]


@pytest.mark.parametrize("limit", [1000, 1])
def test_frequency_index_breaks_ties_by_name(rows, limit):
    df = rows("t string, n long", ("b", 5), ("a", 5), ("c", 9), (None, 100))
    got = numbering.frequency_index(df, "t", "n", "ix", single_task_rows=limit)
    assert tuples(got.select("t", "ix")) == [("a", 1), ("b", 2), ("c", 0)]


def test_size_check_starts_few_tasks(spark):
    spark.sparkContext.setJobGroup("size", "size")
    try:
        assert not numbering.at_most(spark.range(0, 400_000, numPartitions=400), 1000)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("size") for s in tracker.getJobInfo(j).stageIds]
    assert sum(tracker.getStageInfo(s).numTasks for s in stages) < 20


# --- windows

def test_share_of_total(rows):
    df = rows("t string, n long", ("a", 1), ("b", 2))
    assert tuples(windows.share_of_total(df, "n", "pct")) == [("a", 1, 33.33), ("b", 2, 66.67)]


def test_top_k_ties_and_nulls(rows):
    df = rows("k int, v double", (3, 1.0), (2, 1.0), (1, None), (4, 5.0), (5, 0.0))
    assert [r.k for r in windows.top_k(df, F.col("v"), ["k"], 4).collect()] == [1, 4, 2, 3]


def test_running_sum_shares_equal_order_values(rows):
    df = rows("m int, v int", (1, 1), (2, 10), (2, 20), (3, 100))
    assert tuples(windows.running_sum(df, "m", "v", "s").select("m", "s")) == [(1, 1), (2, 31), (2, 31), (3, 131)]


def test_running_compound(rows):
    df = rows("m int, r double", (1, 0.1), (2, 0.1))
    assert [round(r.s, 9) for r in windows.running_compound(df, "m", "r", "s").orderBy("m").collect()] == [0.1, 0.21]


def test_previous_value_is_the_previous_row(rows):
    df = rows("y int, v int", (2020, 1), (2022, 3))
    assert tuples(windows.previous_value(df, "y", "v", "p")) == [(2020, 1, None), (2022, 3, 1)]


# --- statistics

@pytest.mark.parametrize("t, df, p", [
    (2.0, 10.0, 0.073388), (12.7062, 1.0, 0.05), (1.96, 1e6, 0.049996), (0.0, 5.0, 1.0), (1.97, 3500.5, 0.048917),
])
def test_student_tail(spark, t, df, p):
    got = spark.range(1).select(stats.student_two_sided_p(F.lit(t), F.lit(df)).alias("p")).first().p
    assert got == pytest.approx(p, abs=2e-6)


def test_welch_statistic(rows):
    a, b = [1.0, 2.0, 3.0, 4.5], [2.0, 4.0, 6.0, 8.0, 11.0]
    df = rows("g int, f boolean, v double", *[(1, True, x) for x in a], *[(1, False, x) for x in b])
    got = stats.welch(df, ["g"], F.col("f"), "v").first()
    mean = lambda xs: sum(xs) / len(xs)
    var = lambda xs: sum((x - mean(xs)) ** 2 for x in xs) / (len(xs) - 1) / len(xs)
    assert got.t == pytest.approx((mean(a) - mean(b)) / math.sqrt(var(a) + var(b)))
    assert got.freedom == pytest.approx((var(a) + var(b)) ** 2 / (var(a) ** 2 / 3 + var(b) ** 2 / 4))
    assert (got.n_in, got.n_out) == (4, 5) and 0 < got.p < 1


def test_welch_small_and_constant_samples(rows):
    small = rows("g int, f boolean, v double", (1, True, 1.0), (1, False, 2.0), (1, False, 3.0))
    assert stats.welch(small, ["g"], F.col("f"), "v").first().p == 1.0
    flat = rows("g int, f boolean, v double", *[(1, i % 2 == 0, 5.0) for i in range(6)])
    assert stats.welch(flat, ["g"], F.col("f"), "v").first().p is None


def test_safe_corr(rows):
    corr = lambda *pairs: stats.safe_corr(rows("x double, y double", *pairs), "x", "y", "c").first().c
    assert corr((1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (9.0, None)) == pytest.approx(1.0)
    assert corr((1.0, 2.0), (1.0, 5.0)) is None
    assert corr((1.0, 2.0)) is None
