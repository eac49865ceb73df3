import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystrata.functions import casting
from tallystrata.plans import analytics, quality, silver, temporal


def tuples(df):
    return [tuple(r) for r in df.collect()]


def date(text):
    return dt.date.fromisoformat(text)


def tx(rows, *values):
    df = rows("tx_id long, account_id string, tx_at timestamp, tx_type string, amount string", *[
        (i, a, dt.datetime.fromisoformat(t), kind, v) for i, (a, t, kind, v) in enumerate(values)])
    return df.withColumn("amount", casting.to_money(F.col("amount")))


# --- daily series

def daily(rows, *values):
    return rows("date date, cnt long, vol decimal(24,2)", *[(date(d), c, Decimal(v)) for d, c, v in values])


def test_daily_series_has_only_days_with_rows(rows):
    got = temporal.daily_series(tx(rows, ("A", "2020-01-01T10:00:00", "x", "-5"), ("A", "2020-01-01", "x", None),
                                   ("A", "2020-01-03", "x", "2")))
    assert sorted((r.date, r.cnt, float(r.vol)) for r in got.collect()) == [(date("2020-01-01"), 2, 5.0), (date("2020-01-03"), 1, 2.0)]


def test_burst_days(rows):
    series = daily(rows, ("2020-01-01", 201, "1"), ("2020-01-02", 200, "1"), ("2020-01-03", 5, "1"))
    assert [r.date for r in temporal.burst_days(series).collect()] == [date("2020-01-01")]
    assert tuples(temporal.burst_summary(series)) == [(1, 205, 406, ["2020-01-01"])]


def test_means_are_over_days(rows):
    series = daily(rows, ("2020-01-06", 1, "10"), ("2020-01-13", 2, "15"), ("2020-04-06", 3, "1"))
    days = temporal.scoped(series)
    quarters = {(r.scope, r.quarter): (r.mean_cnt, r.mean_vol) for r in temporal.seasonality_by_quarter(days).collect()}
    assert quarters == {("all", 1): (1.5, 12), ("all", 2): (3.0, 1)}   # 12.5 rounds half-even
    weekdays = {(r.scope, r.weekday): r.mean_cnt for r in temporal.seasonality_by_weekday(days).collect()}
    assert weekdays == {("all", 0): 2.0}


def test_years_need_more_than_three_days(rows):
    series = daily(rows, *[(f"2020-01-0{i}", i, "1") for i in range(1, 5)], *[(f"2021-01-0{i}", i, "1") for i in range(1, 4)],
                   *[(f"2019-01-0{i}", i, "1") for i in range(1, 9)])
    got = {r.scope: r.n for r in temporal.scoped(series).groupBy("scope").agg(F.count("*").alias("n")).collect()}
    assert got == {"all": 15, "2020": 4}


def test_small_sample_has_p_one(rows):
    series = daily(rows, ("2020-01-01", 1, "1"), ("2020-02-01", 2, "2"), ("2020-05-01", 9, "3"))
    flag = temporal.month_flag_test(temporal.scoped(series)).first()
    assert (flag.n_in, flag.n_out, flag.mean_in, flag.mean_out, flag.p) == (2, 1, 1.5, 9.0, 1.0)


def test_parity_uses_volume(rows):
    series = daily(rows, *[(f"2020-02-{d:02}", 1, str(d)) for d in (1, 2, 3)], *[(f"2020-03-{d:02}", 1, str(d + 40)) for d in (1, 2, 3)])
    got = temporal.month_parity_test(temporal.scoped(series)).filter("scope = 'all'").first()
    assert (got.mean_in, got.mean_out, got.p) == (2.0, 42.0, 0.0)


def test_index_slice(rows):
    df = rows("year int, month int, month_pct double, pct_12m double", (2017, 12, 1.0, 1.0), (2018, 2, 0.32, None), (2018, 1, 0.29, 2.86))
    assert tuples(temporal.index_slice(df)) == [(2018, 1, 0.29, 2.86), (2018, 2, 0.32, None)]


# --- customers and credit

def test_client_kpis_and_bands(rows):
    df = rows("client_id int, client_kind string, birth_date date", (1, "PF", date("1990-06-01")), (2, "PJ", date("2000-02-29")), (3, "PF", None))
    assert tuples(analytics.client_kpis(df, "2023-02-28")) == [(3, 2, 1, 27.0)]
    assert tuples(analytics.clients_by_age_band(df, "2023-02-28")) == [("a) <30", 1, 22.0), ("b) 30-44", 1, 32.0), ("d) 60+", 1, None)]


def test_address_tail(rows):
    df = rows("address string", ("Rua A / PE",), ("Rua B / PE",), ("Rua C",))
    assert tuples(analytics.clients_by_address_tail(df)) == [(" PE", 2), ("Rua C", 1)]
    assert tuples(analytics.clients_by_address_tail(df, k=1, trimmed=True)) == [("PE", 2)]


def test_client_balances(rows):
    clients = rows("client_id long, first_name string, last_name string", (1, "Ana", "Sá"), (2, "Bia", None), (3, "C", "D"))
    accounts = rows("account_id string, client_id long, balance int", ("a", 1, 5), ("b", 1, 6), ("c", 2, None), (None, 2, 7), ("z", 9, 99))
    assert tuples(analytics.client_balances(clients, accounts)) == [(1, "Ana Sá", 11.0, 2), (2, None, 7.0, 1)]


def proposals(rows):
    df = rows("employee_id long, submitted_at timestamp, monthly_rate double, installments int, financed_amount string, status string",
              (1, dt.datetime(2020, 1, 5), 0.0166, 10, "100", "Aprovado"), (1, dt.datetime(2020, 1, 9), 0.0167, 40, "50.01", "Aprovado"),
              (2, dt.datetime(2020, 2, 9), None, None, "70", "Enviado"), (9, dt.datetime(2020, 2, 9), 0.02, 61, "500", "Aprovado"))
    return df.withColumn("financed_amount", casting.to_money(F.col("financed_amount")))


def test_credit(rows):
    df = proposals(rows)
    assert tuples(analytics.credit_kpis(df)) == [(4, 1.78, 37.0, 180.0)]
    assert tuples(analytics.status_share(df)) == [("Aprovado", 3, 75.0), ("Enviado", 1, 25.0)]
    assert dict((t, (n, r)) for t, n, r in tuples(analytics.rate_by_tenor(df))) == {
        "curto (até 12)": (1, 1.66), "longo (37-60)": (1, 1.67), "muito longo (60+)": (2, 2.0)}


def test_top_employees(rows):
    people = rows("employee_id long, first_name string, last_name string, role string", (1, "Ana", "Sá", "Gerente"), (2, "B", "C", "x"))
    assert tuples(analytics.top_employees(proposals(rows), people)) == [(1, "Ana Sá", "Gerente", 2, 150.01)]


# --- index

def index(rows, *values):
    return rows("month_start date, month_rate decimal(10,6)", *[(date(m), Decimal(r)) for m, r in values])


def test_running_index(rows):
    series = index(rows, ("2019-12-01", "0.5"), ("2020-01-01", "0.0021"), ("2020-02-01", "0.0025"))
    assert tuples(analytics.index_running(series, "2020-01-01", "2022-12-31")) == [
        (date("2020-01-01"), 0.21, 0.21), (date("2020-02-01"), 0.25, 0.46)]
    compound = analytics.index_running(series, "2020-01-01", "2022-12-31", compound=True).collect()
    assert compound[1].running_pct == pytest.approx((1.0021 * 1.0025 - 1) * 100)


# Published Brazilian consumer prices, percent per month, January 2020 to November 2022.
PRICES = (
    0.21, 0.25, 0.07, -0.31, -0.38, 0.26, 0.36, 0.24, 0.64, 0.86, 0.89, 1.35,
    0.25, 0.86, 0.93, 0.31, 0.83, 0.53, 0.96, 0.87, 1.16, 1.25, 0.95, 0.73,
    0.54, 1.01, 1.62, 1.06, 0.47, 0.67, -0.68, -0.36, -0.29, 0.59, 0.41,
)


def test_published_index_figures(rows):
    monthly = rows("year int, month int, month_pct double, pct_12m double", *[
        (2020 + i // 12, 1 + i % 12, p, None) for i, p in enumerate(PRICES)])
    series = silver.index_series(monthly)
    running = analytics.index_running(series, "2020-01-01", "2022-12-31").collect()
    assert len(running) == 35 and running[-1].running_pct == 19.11
    assert max(running, key=lambda r: r.month_pct)[:2] == (date("2022-03-01"), 1.62)
    compound = analytics.index_running(series, "2020-01-01", "2022-12-31", compound=True).collect()
    assert round(compound[-1].running_pct, 2) == 20.94


def test_withdrawals_beside_index(rows):
    data = tx(rows, ("A", "2020-01-05", "Saque", "-10"), ("A", "2020-01-06", "saque x", "5.5"), ("A", "2020-03-06", "Saque", "1"), ("A", "2020-01-06", "Pix", "9"))
    series = index(rows, ("2020-01-01", "0.0021"), ("2020-02-01", "0.0025"))
    assert tuples(analytics.withdrawals_vs_index(data, series)) == [
        (date("2020-01-01"), 2, 15.5, 0.21), (date("2020-03-01"), 1, 1.0, None)]
    pairs = analytics.index_withdrawal_pairs(data, series, "2020-01-01", "2022-12-31")
    assert {r.month_start: r.volume is None for r in pairs.collect()} == {date("2020-01-01"): False, date("2020-02-01"): True}


def test_credit_beside_index(rows):
    series = index(rows, ("2020-01-01", "0.0021"))
    assert tuples(analytics.credit_vs_index(proposals(rows), series)) == [
        (date("2020-01-01"), 2, 150.01, 0.21), (date("2020-02-01"), 1, 500.0, None)]


def test_correlation_with_constant_index_is_null(rows):
    data = tx(rows, ("A", "2020-01-05", "Saque", "1"), ("A", "2020-02-05", "Saque", "2"), ("A", "2020-03-05", "Saque", "4"))
    flat = index(rows, *[(f"2020-0{m}-01", "0.001") for m in (1, 2, 3)])
    assert analytics.index_withdrawal_corr(data, flat, "2020-01-01", "2022-12-31").first().correlation is None
    rising = index(rows, *[(f"2020-0{m}-01", f"0.00{m}") for m in (1, 2, 3)])
    assert analytics.index_withdrawal_corr(data, rising, "2020-01-01", "2022-12-31").first().correlation == pytest.approx(0.9819805)


# --- transactions

def test_transaction_analyses(rows):
    data = tx(rows, ("A", "2019-01-05", "Pix", "-10"), ("B", "2019-02-06", "Saque", "5.01"), ("A", "2021-01-06", None, None), ("B", "2021-01-07", "Pix", "30"))
    kpis = analytics.tx_kpis(data).first()
    assert (kpis.transactions, kpis.volume, kpis.mean_ticket) == (4, 45.01, 15.0)
    assert (kpis.first_at, kpis.last_at) == (dt.datetime(2019, 1, 5), dt.datetime(2021, 1, 7))
    assert tuples(analytics.tx_by_kind(data)) == [("Pix", 2, 40.0, 50.0), ("Saque", 1, 5.01, 25.0), (None, 1, None, 25.0)]
    assert tuples(analytics.month_profile(data)) == [(1, 3, 20.0, 40.0), (2, 1, 5.01, 5.01)]
    assert tuples(analytics.annual_change(data)) == [(2019, 15.01, None, None), (2021, 30.0, 15.01, 99.87)]
    assert tuples(analytics.top_accounts(data, k=1)) == [("B", 2, 35.01)]


def test_change_from_zero_is_null(rows):
    data = tx(rows, ("A", "2019-01-05", "Pix", "0"), ("A", "2020-01-05", "Pix", "5"))
    assert tuples(analytics.annual_change(data))[1] == (2020, 5.0, 0.0, None)


def test_row_counts(rows):
    got = analytics.row_counts({"a": rows("x int", (1,), (2,)), "b": rows("x int")})
    assert sorted(tuples(got)) == [("a", 2), ("b", 0)]


# --- quality measures

def test_duplicates_and_nulls(rows):
    df = rows("k int, v int", (1, 1), (1, None), (None, 1), (None, 1))
    assert quality.duplicate_count(df, "k").first().duplicates == 2
    assert tuples(quality.null_counts(df, ["k", "v"])) == [(4, 2, 1)]


def test_balance_profile(rows):
    assert tuples(quality.balance_profile(rows("balance double", (-1.0,), (0.0,), (None,)))) == [(1, 1)]


@pytest.mark.parametrize("counted, passed", [(15, True), (16, False), (5, True), (4, False)])
def test_totals_tolerance(rows, spark, counted, passed):
    data = spark.range(10).select(F.lit("2020-01-01").cast("timestamp").alias("tx_at"))
    assert quality.totals_gap(data, rows("cnt long", (counted,))).first().passed is passed


def test_missing_names(spark):
    assert [r.name for r in quality.missing_names(spark, ["a", "b"], ["b", "c"]).collect()] == ["a"]
