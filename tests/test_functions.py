import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallystrata.functions import calendar, casting, labels, numeric


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def text(v):
    return F.lit(v).cast("string")


@pytest.mark.parametrize("given, expected", [("12.5", 12.5), ("abc", None), (None, None), (" 7 ", 7.0), ("1e3", 1000.0)])
def test_money_from_text(spark, given, expected):
    got = value(spark, casting.to_money(text(given)))
    assert (None if got is None else float(got)) == expected


def test_rate_has_no_nan(spark):
    assert value(spark, casting.to_rate(text("NaN"))) is None
    assert value(spark, casting.to_rate(text("0.0167"))) == 0.0167


@pytest.mark.parametrize("given, expected", [("12", 12), ("12.0", 12), ("x", None)])
def test_int_from_text(spark, given, expected):
    assert value(spark, casting.to_int(text(given))) == expected


def test_whole_number_keys(spark):
    assert value(spark, casting.to_key(text(" 12.0 "))) == 12
    assert value(spark, casting.to_key(text(None))) is None
    assert value(spark, casting.to_key(text(" 007-X "), "string")) == "007-X"


def test_invalid_key_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, casting.to_key(text("12a")))


@pytest.mark.parametrize("given", ["", "NA", "null", "None", "N/A"])
def test_missing_marks(spark, given):
    assert value(spark, casting.missing_to_null(text(given))) is None


@pytest.mark.parametrize("given", [
    "2020-01-02 03:04:05 UTC", "2020-01-02T03:04:05Z", "2020-01-02 03:04:05.000000", "2020-01-02 00:04:05-03:00",
    "2020/01/02 03:04:05", "01/02/2020 03:04:05",
])
def test_mixed_timestamps_are_one_instant(spark, given):
    got = value(spark, F.date_format(casting.to_utc_timestamp_mixed(text(given)), "yyyy-MM-dd HH:mm:ss"))
    assert got == "2020-01-02 03:04:05"


def test_date_only_and_garbage_timestamps(spark):
    mixed = lambda v: value(spark, F.date_format(casting.to_utc_timestamp_mixed(text(v)), "yyyy-MM-dd HH:mm"))
    assert mixed("2020-01-02") == "2020-01-02 00:00"
    assert mixed("31/12/2020") == "2020-12-31 00:00"
    assert mixed("amanhã") is None and mixed("2020-13-45") is None


def test_optional_column(rows):
    df = rows("a int", (1,))
    assert df.select(casting.optional(df, "b", "double").alias("b")).dtypes == [("b", "double")]


@pytest.mark.parametrize("birth, age, band", [
    ("1999-01-15", 25.0, "Adulto (25-59)"),   # 24.961 before rounding
    ("1999-02-15", 24.9, "Jovem (<25)"),
    ("1963-12-01", 60.1, "Idoso (60+)"),
    (None, None, "Indefinida"),
])
def test_rounding_precedes_banding(spark, birth, age, band):
    got = calendar.decimal_age(F.lit(birth).cast("date"), "2024-01-01")
    assert value(spark, got) == age
    assert value(spark, labels.age_band(got)) == band


@pytest.mark.parametrize("birth, as_of, years", [
    ("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-02-29", "2024-02-29", 24),
    ("2000-05-10", "2023-05-09", 22), ("2000-05-10", "2023-05-10", 23),
])
def test_completed_years(spark, birth, as_of, years):
    assert value(spark, calendar.completed_years(F.lit(birth).cast("date"), as_of)) == years


def test_calendar_parts(spark):
    monday = F.lit("2024-01-01").cast("timestamp_ntz")
    assert value(spark, calendar.weekday(monday)) == 0
    assert value(spark, calendar.quarter(monday)) == 1
    assert value(spark, calendar.month_start(F.lit("2024-02-29").cast("timestamp_ntz"))) == dt.date(2024, 2, 1)
    assert value(spark, calendar.iso_date(monday)) == "2024-01-01"


def test_report_band_of_null(spark):
    null = F.lit(None).cast("int")
    assert value(spark, labels.report_age_band(null)) == "d) 60+"
    assert value(spark, labels.report_age_band(null, "unknown")) == "unknown"
    assert [value(spark, labels.report_age_band(F.lit(a))) for a in (29, 30, 44, 45, 59, 60)] == [
        "a) <30", "b) 30-44", "b) 30-44", "c) 45-59", "c) 45-59", "d) 60+"]


@pytest.mark.parametrize("n, label", [
    (12, "curto (até 12)"), (13, "médio (13-36)"), (36, "médio (13-36)"), (60, "longo (37-60)"),
    (61, "muito longo (60+)"), (None, "muito longo (60+)"),
])
def test_tenor(spark, n, label):
    assert value(spark, labels.tenor_band(F.lit(n).cast("int"))) == label


@pytest.mark.parametrize("pct, expected", [
    (0.7, None), (0.8, 0), (1.0, 0), (1.1, 1), (0.014 * 100, 3), (1.4, 2), (2.5, 7), (2.6, None), (None, None),
])
def test_rate_bins(spark, pct, expected):
    col = F.lit(pct).cast("double")
    assert value(spark, labels.bin_index(col, labels.RATE_BIN_EDGES)) == expected
    assert value(spark, labels.bin_index(col, labels.RATE_BIN_EDGES, clamp_to_zero=True)) == (expected or 0)


@pytest.mark.parametrize("status, code", [
    ("Aprovada", 1), ("APROVADO", 1), ("Validação documentos", 2), ("Em análise", 3), ("Em analise", 3), ("Enviada", 0),
    ("Aprovada em validação", 1), (None, 0),
])
def test_status(spark, status, code):
    assert value(spark, labels.status_code(text(status))) == code


def test_text_helpers(spark):
    assert value(spark, labels.without(text(" Agência Sul "), labels.BRANCH_NAME_NOISE)) == "Sul"
    assert value(spark, labels.without(text("Agencia Norte\t"), labels.BRANCH_NAME_NOISE)) == "Norte"
    assert value(spark, labels.without(text(None), labels.BRANCH_NAME_NOISE)) is None
    assert value(spark, labels.last_part(text("Rua A / PE"), "/")) == " PE"
    assert value(spark, labels.last_part(text("Rua A / PE"), "/", trimmed=True)) == "PE"
    assert value(spark, labels.last_part(text("Rua A"), "/")) == "Rua A"
    assert value(spark, labels.full_name(text("A"), text(None))) is None
    assert value(spark, labels.contains_text(text("SAQUE eletrônico"), "saque")) is True
    assert value(spark, labels.contains_text(text(None), "saque")) is False


def test_fixed_lists(spark):
    assert value(spark, labels.month_number(text("dez"))) == 12
    assert value(spark, labels.month_number(text("XXX"))) is None
    assert value(spark, labels.month_number(text(None))) is None
    assert value(spark, labels.age_band_index(text("Indefinida"))) == 3
    assert value(spark, labels.age_band_index(text(None))) == 3
    assert value(spark, labels.ordinal(text("MG"), labels.ACTIVE_STATES)) is None


def test_rounding(spark):
    assert value(spark, numeric.half_even(F.lit(2.5), 0)) == 2.0
    assert value(spark, numeric.half_up(F.lit(2.5), 0)) == 3.0
    assert value(spark, numeric.half_up(F.lit("-2.345").cast("decimal(10,3)"), 2).cast("double")) == -2.35


def test_sums_and_means(rows):
    df = rows("k string, x string", ("a", "0.10"), ("a", "0.20"), ("b", None)).withColumn("x", casting.to_money(F.col("x")))
    got = {r.k: (float(r.s), None if r.m is None else float(r.m)) for r in df.groupBy("k").agg(
        numeric.money_sum(F.col("x")).alias("s"), numeric.money_mean(F.col("x")).alias("m")).collect()}
    assert got == {"a": (0.3, 0.15), "b": (0.0, None)}


def test_mean_ties_are_exact(rows):
    df = rows("x string", ("1.01",), ("1.02",)).select(casting.to_money(F.col("x")).alias("x"))
    assert float(df.agg(numeric.half_up(numeric.money_mean(F.col("x")), 2).alias("m")).first().m) == 1.02


def test_rates_out_of_range_do_not_stop_a_mean(rows):
    df = rows("x double", (0.01,), (0.02,), (1e300,), (None,))
    assert float(df.agg(numeric.rate_mean(F.col("x")).alias("m")).first().m) == 0.015


def test_guarded_ratio(spark):
    assert value(spark, numeric.ratio(F.lit(1.0), F.lit(0.0))) is None
