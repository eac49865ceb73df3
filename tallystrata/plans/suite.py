"""The seventeen analyses bound to the silver tables of a lake."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.layers import Lake
from . import analytics, silver

PERIOD = ("2020-01-01", "2022-12-31")   # fixed value: the period of the index analyses


def analyses(lake: Lake, as_of: str, period: tuple[str, str] = PERIOD) -> dict[str, DataFrame]:
    """Lazy results by name; ages are completed years on ``as_of``."""
    clients, accounts, employees = lake.silver("clients"), lake.silver("accounts"), lake.silver("employees")
    proposals, transactions = lake.silver("proposals"), lake.silver("transactions")
    index = silver.index_series(lake.silver("price_index"))
    return {
        "client_kpis": analytics.client_kpis(clients, as_of),
        "clients_by_address_tail": analytics.clients_by_address_tail(clients),
        "clients_by_age_band": analytics.clients_by_age_band(clients, as_of),
        "client_balances": analytics.client_balances(clients, accounts),
        "credit_kpis": analytics.credit_kpis(proposals),
        "status_share": analytics.status_share(proposals),
        "rate_by_tenor": analytics.rate_by_tenor(proposals),
        "top_employees": analytics.top_employees(proposals, employees),
        "index_running": analytics.index_running(index, *period),
        "withdrawals_vs_index": analytics.withdrawals_vs_index(transactions, index),
        "credit_vs_index": analytics.credit_vs_index(proposals, index),
        "index_withdrawal_corr": analytics.index_withdrawal_corr(transactions, index, *period),
        "tx_kpis": analytics.tx_kpis(transactions),
        "tx_by_kind": analytics.tx_by_kind(transactions),
        "month_profile": analytics.month_profile(transactions),
        "annual_change": analytics.annual_change(transactions),
        "top_accounts": analytics.top_accounts(transactions),
    }
