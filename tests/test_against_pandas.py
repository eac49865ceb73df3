"""Column rules against the dataframe library whose semantics they follow, on random and awkward values."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallystrata.functions import calendar, casting, labels, numeric
from tallystrata.operators import dedup, stats


def column(spark, values, kind, expression):
    """Results of an expression over ``x``, in the order of the values."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_rate_bins_equal_cut(spark):
    rng = random.Random(3)
    edges = list(labels.RATE_BIN_EDGES)
    pct = [rng.uniform(0.5, 3) for _ in range(300)] + edges + [e / 100 * 100 for e in edges] + [
        x / 1000 * 100 for x in range(5, 30)] + [float(np.nextafter(e, s)) for e in edges for s in (0, 9)]
    want = pd.cut(pd.Series(pct), bins=edges, labels=False, include_lowest=True)
    got = column(spark, pct, "double", lambda x: labels.bin_index(x, edges))
    assert got == [None if pd.isna(w) else int(w) for w in want]


def test_numbers_equal_coercion(spark):
    text = ["1", " 2.50 ", "-3", "+4", "1e3", "", "abc", "1,5", "R$ 3", "0.0167", None, "12.345.678", "1_000"]
    want = pd.to_numeric(pd.Series(text), errors="coerce")
    got = column(spark, text, "string", casting.to_rate)
    assert got == [None if pd.isna(w) else float(w) for w in want]


def test_timestamps_equal_mixed_parsing(spark):
    text = ["2020-01-02 03:04:05 UTC", "2020-01-02T03:04:05.123456Z", "2020-01-02 03:04:05-03:00", "2020-01-02",
            "2020/01/02", "2020-01-02 03:04", "02/28/2020", "28/02/2020", "not a date", None, "2020-02-30",
            "2020-01-02 25:00:00", "2019-12-31 23:59:59.999"]
    want = pd.to_datetime(pd.Series(text), format="mixed", utc=True, errors="coerce")
    got = column(spark, text, "string", lambda x: F.unix_micros(casting.to_utc_timestamp_mixed(x)))
    assert got == [None if pd.isna(w) else w.value // 1000 for w in want]


def test_decimal_ages(spark):
    rng = random.Random(5)
    births = [dt.date(1930, 1, 1) + dt.timedelta(rng.randrange(35000)) for _ in range(400)]
    as_of = dt.date(2024, 1, 1)
    want = [round((as_of - b).days / 365.25, 1) for b in births]
    assert column(spark, births, "date", lambda x: calendar.decimal_age(x, "2024-01-01")) == want


def test_completed_years_count_birthdays(spark):
    rng = random.Random(6)
    births = [dt.date(1950, 1, 1) + dt.timedelta(rng.randrange(25000)) for _ in range(300)] + [dt.date(2000, 2, 29)]
    for as_of in (dt.date(2023, 2, 28), dt.date(2024, 2, 29), dt.date(2023, 7, 1)):
        want = [as_of.year - b.year - ((as_of.month, as_of.day) < (b.month, b.day)) for b in births]
        assert column(spark, births, "date", lambda x: calendar.completed_years(x, as_of.isoformat())) == want


def test_weekdays_and_quarters(spark):
    days = [dt.date(2019, 12, 25) + dt.timedelta(i) for i in range(400)]
    index = pd.DatetimeIndex(days)
    assert column(spark, days, "date", calendar.weekday) == list(index.dayofweek)
    assert column(spark, days, "date", calendar.quarter) == list(index.quarter)


def test_half_even_rounding_of_counts(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(1, 5000), rng.choice([1, 2, 4, 8, 3, 7])) for _ in range(300)]
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(pairs)], "i int, s long, n long")
    mean = numeric.half_even(numeric.mean_of(F.col("s"), F.col("n")), 2).cast("double")
    # quotients by powers of two are exact in binary, so Python's rounding is exact there
    got = [r.m for r in df.select("i", mean.alias("m")).orderBy("i").collect()]
    assert [g for g, (_, n) in zip(got, pairs) if n in (1, 2, 4, 8)] == [round(s / n, 2) for s, n in pairs if n in (1, 2, 4, 8)]
    assert all(abs(g - s / n) <= 0.0051 for g, (s, n) in zip(got, pairs))


def test_first_duplicate_survives(spark):
    rng = random.Random(9)
    frame = pd.DataFrame({"k": [rng.choice([None, 1, 2, 3, 4]) for _ in range(200)], "v": [rng.random() for _ in range(200)]})
    frame["pos"] = range(200)
    want = frame.drop_duplicates(subset=["k"])
    df = spark.createDataFrame([(None if pd.isna(k) else int(k), v, p) for k, v, p in frame.itertuples(index=False)], "k int, v double, pos int")
    got = dedup.keep_first(df.repartition(5), ["k"], ["pos"])
    assert sorted(r.pos for r in got.collect()) == list(want["pos"])


@pytest.mark.parametrize("seed", range(3))
def test_moments_and_p_value(spark, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(10, 3, 30 + seed), rng.normal(11, 5, 17)
    df = spark.createDataFrame([(True, float(x)) for x in a] + [(False, float(x)) for x in b], "f boolean, v double")
    got = stats.welch(df.withColumn("g", F.lit(1)), ["g"], F.col("f"), "v").first()
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    t = (a.mean() - b.mean()) / np.sqrt(va + vb)
    freedom = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
    assert got.t == pytest.approx(t) and got.freedom == pytest.approx(freedom)
    # tail of the density by a fine sum
    x = np.linspace(abs(t), abs(t) + 400, 4_000_001)
    y = (1 + x ** 2 / freedom) ** (-(freedom + 1) / 2)
    z = np.linspace(-400, 400, 4_000_001)
    whole = np.trapezoid((1 + z ** 2 / freedom) ** (-(freedom + 1) / 2), z)
    assert got.p == pytest.approx(2 * np.trapezoid(y, x) / whole, abs=1e-6)


def test_correlation(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=60)
    y = x * 0.4 + rng.normal(size=60)
    df = spark.createDataFrame([(float(p), float(q)) for p, q in zip(x, y)], "x double, y double")
    assert stats.safe_corr(df, "x", "y", "c").first().c == pytest.approx(np.corrcoef(x, y)[0, 1])
