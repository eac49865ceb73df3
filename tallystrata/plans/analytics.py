"""Customer, credit, index and transaction analyses, with the null rules of SQL.

Money is summed as decimal and returned as double. A sum without any value is null, and rankings put it first.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar, labels
from ..functions.numeric import amount, as_double, exact_mean, half_up, int_mean, percent, rate_mean, ratio
from ..operators.stats import safe_corr
from ..operators.windows import previous_value, running_compound, running_sum, share_of_total, top_k


def _rows() -> Column:
    return F.count(F.lit(1))


def _sum(col: Column) -> Column:
    return F.sum(col)


def _money(col: Column) -> Column:
    return as_double(_sum(col))


# --- customers -------------------------------------------------------------------------------------------------

def client_kpis(clients: DataFrame, as_of: str, kinds: Mapping[str, str] | None = None) -> DataFrame:
    """Client count, count per kind, mean completed years. ``kinds`` maps output name to the kind counted."""
    kinds = {"individuals": "PF", "companies": "PJ"} if kinds is None else kinds
    return clients.agg(
        _rows().alias("clients"),
        *[F.count_if(F.col("client_kind") == kind).alias(name) for name, kind in kinds.items()],
        half_up(int_mean(calendar.completed_years(F.col("birth_date"), as_of)), 1).cast("double").alias("mean_age"),
    )


def clients_by_address_tail(
    clients: DataFrame, k: int = 5, address: str = "address", separator: str = "/", trimmed: bool = False
) -> DataFrame:
    tail = labels.last_part(F.col(address), separator, trimmed)
    counts = clients.groupBy(tail.alias("state_guess")).agg(_rows().alias("clients"))
    return top_k(counts, F.col("clients"), ["state_guess"], k)


def clients_by_age_band(clients: DataFrame, as_of: str, null_label: str | None = None) -> DataFrame:
    """Count and mean completed years per band; without ``null_label`` a missing birth date counts as the last band."""
    ages = clients.select(calendar.completed_years(F.col("birth_date"), as_of).alias("age"))
    return (
        ages.groupBy(labels.report_age_band(F.col("age"), null_label).alias("band"))
        .agg(_rows().alias("clients"), half_up(int_mean(F.col("age")), 1).cast("double").alias("mean_age"))
        .orderBy("band")
    )


def client_balances(clients: DataFrame, accounts: DataFrame, k: int = 10) -> DataFrame:
    """Largest balances over all accounts of a client. Accounts are summed per client before the join."""
    sums = accounts.filter(F.col("client_id").isNotNull()).groupBy("client_id").agg(
        _sum(amount(accounts, "balance")).alias("balance"), F.count("account_id").alias("accounts")
    )
    named = sums.join(
        clients.select("client_id", labels.full_name(F.col("first_name"), F.col("last_name")).alias("name")), "client_id"
    )
    best = top_k(named, F.col("balance"), ["client_id"], k)
    return best.select("client_id", "name", as_double(F.col("balance")).alias("balance"), "accounts")


# --- credit ----------------------------------------------------------------------------------------------------

def credit_kpis(proposals: DataFrame) -> DataFrame:
    return proposals.agg(
        _rows().alias("proposals"),
        half_up(percent(rate_mean(F.col("monthly_rate"))), 2).cast("double").alias("mean_rate_pct"),
        half_up(int_mean(F.col("installments")), 0).cast("double").alias("mean_installments"),
        half_up(exact_mean(amount(proposals, "financed_amount")), 2).cast("double").alias("mean_financed"),
    )


def status_share(proposals: DataFrame) -> DataFrame:
    counts = proposals.groupBy("status").agg(_rows().alias("proposals"))
    return share_of_total(counts, "proposals", "share_pct", counted=proposals).orderBy(
        F.col("proposals").desc(), F.col("status").asc_nulls_last()
    )


def rate_by_tenor(proposals: DataFrame) -> DataFrame:
    return (
        proposals.groupBy(labels.tenor_band(F.col("installments")).alias("tenor"))
        .agg(
            _rows().alias("proposals"),
            half_up(percent(rate_mean(F.col("monthly_rate"))), 2).cast("double").alias("mean_rate_pct"),
        )
        .orderBy("tenor")
    )


def top_employees(
    proposals: DataFrame, employees: DataFrame, status: str = labels.APPROVED_STATUS, k: int = 10
) -> DataFrame:
    """Employees by approved volume. Proposals are summed per employee before the join."""
    sums = (
        proposals.filter((F.col("status") == status) & F.col("employee_id").isNotNull())
        .groupBy("employee_id").agg(_rows().alias("proposals"), _money(amount(proposals, "financed_amount")).alias("financed"))
    )
    role = ["role"] if "role" in employees.columns else []
    names = employees.select(
        "employee_id", labels.full_name(F.col("first_name"), F.col("last_name")).alias("name"), *role
    )
    return top_k(sums.join(names, "employee_id"), F.col("financed"), ["employee_id"], k).select(
        "employee_id", "name", *role, "proposals", "financed"
    )


# --- monthly index ---------------------------------------------------------------------------------------------

def index_running(index: DataFrame, first: str, last: str, compound: bool = False) -> DataFrame:
    """Monthly percentage and its running total in a period: a plain sum, or compounded on request."""
    period = index.filter(F.col("month_start").between(calendar.date_literal(first), calendar.date_literal(last)))
    if compound:
        total = running_compound(period, "month_start", "month_rate", "running")
    else:
        total = running_sum(period, "month_start", "month_rate", "running")
    return total.select(
        "month_start",
        as_double(percent(F.col("month_rate"))).alias("month_pct"),
        as_double(percent(F.col("running"))).alias("running_pct"),
    ).orderBy("month_start")


def monthly_withdrawals(transactions: DataFrame, text: str = labels.WITHDRAWAL_TEXT) -> DataFrame:
    return (
        transactions.filter(labels.contains_text(F.col("tx_type"), text))
        .groupBy(calendar.month_start(F.col("tx_at")).alias("month_start"))
        .agg(_rows().alias("withdrawals"), _sum(F.abs(amount(transactions, "amount"))).alias("volume"))
    )


def monthly_credit(proposals: DataFrame, status: str = labels.APPROVED_STATUS) -> DataFrame:
    return (
        proposals.filter(F.col("status") == status)
        .groupBy(calendar.month_start(F.col("submitted_at")).alias("month_start"))
        .agg(_rows().alias("proposals"), _sum(amount(proposals, "financed_amount")).alias("volume"))
    )


def against_index(monthly: DataFrame, index: DataFrame) -> DataFrame:
    """Monthly counts and volume beside the index; months without an index keep a null."""
    joined = monthly.join(index.select("month_start", "month_rate"), "month_start", "left")
    counts = [c for c in monthly.columns if c not in ("month_start", "volume")]
    return joined.select(
        "month_start", *counts,
        as_double(F.col("volume")).alias("volume"),
        as_double(half_up(percent(F.col("month_rate")), 2)).alias("index_pct"),
    ).orderBy(F.col("month_start").asc_nulls_last())


def withdrawals_vs_index(transactions: DataFrame, index: DataFrame, text: str = labels.WITHDRAWAL_TEXT) -> DataFrame:
    return against_index(monthly_withdrawals(transactions, text), index)


def credit_vs_index(proposals: DataFrame, index: DataFrame, status: str = labels.APPROVED_STATUS) -> DataFrame:
    return against_index(monthly_credit(proposals, status), index)


def index_withdrawal_pairs(
    transactions: DataFrame, index: DataFrame, first: str, last: str, text: str = labels.WITHDRAWAL_TEXT
) -> DataFrame:
    """Every index month of the period with its withdrawal volume, null where there was none.

    The transactions are aggregated under the text predicate before the join, so both sides are one row per month.
    """
    period = index.filter(F.col("month_start").between(calendar.date_literal(first), calendar.date_literal(last)))
    monthly = monthly_withdrawals(transactions, text).select("month_start", "volume")
    return period.select("month_start", "month_rate").join(monthly, "month_start", "left")


def index_withdrawal_corr(
    transactions: DataFrame, index: DataFrame, first: str, last: str, text: str = labels.WITHDRAWAL_TEXT
) -> DataFrame:
    pairs = index_withdrawal_pairs(transactions, index, first, last, text)
    return safe_corr(pairs, "month_rate", "volume", "correlation")


# --- transactions ----------------------------------------------------------------------------------------------

def tx_kpis(transactions: DataFrame) -> DataFrame:
    size = F.abs(amount(transactions, "amount"))
    return transactions.agg(
        _rows().alias("transactions"),
        _money(size).alias("volume"),
        half_up(exact_mean(size), 2).cast("double").alias("mean_ticket"),
        F.min("tx_at").alias("first_at"),
        F.max("tx_at").alias("last_at"),
    )


def tx_by_kind(transactions: DataFrame) -> DataFrame:
    counts = transactions.groupBy("tx_type").agg(_rows().alias("transactions"), _money(F.abs(amount(transactions, "amount"))).alias("volume"))
    return share_of_total(counts, "transactions", "share_pct", counted=transactions).orderBy(
        F.col("transactions").desc(), F.col("tx_type").asc_nulls_last()
    )


def month_profile(transactions: DataFrame) -> DataFrame:
    size = F.abs(amount(transactions, "amount"))
    return (
        transactions.groupBy(calendar.month(F.col("tx_at")).alias("month"))
        .agg(
            _rows().alias("transactions"),
            half_up(exact_mean(size), 2).cast("double").alias("mean_ticket"),
            _money(size).alias("volume"),
        )
        .orderBy(F.col("month").asc_nulls_last())
    )


def annual_change(transactions: DataFrame) -> DataFrame:
    """Yearly volume, the volume of the year row before and the change in percent."""
    annual = transactions.groupBy(calendar.year(F.col("tx_at")).alias("year")).agg(
        _sum(F.abs(amount(transactions, "amount"))).alias("volume")
    )
    with_previous = previous_value(annual, "year", "volume", "previous")
    change = ratio(F.col("volume"), F.col("previous")) - 1
    return with_previous.select(
        "year",
        as_double(F.col("volume")).alias("volume"),
        as_double(F.col("previous")).alias("previous_volume"),
        half_up(percent(change), 2).cast("double").alias("change_pct"),
    ).orderBy("year")


def top_accounts(transactions: DataFrame, k: int = 10) -> DataFrame:
    sums = transactions.groupBy("account_id").agg(
        _rows().alias("transactions"), _money(F.abs(amount(transactions, "amount"))).alias("volume")
    )
    return top_k(sums, F.col("volume"), ["account_id"], k)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(_rows().alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
