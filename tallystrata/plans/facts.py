"""Enrichment joins and the aggregate facts.

Branch positions and age bands are attached to the dimensions, the dimensions are joined to transactions and proposals
once, and every fact is a roll-up of the placed rows. Rolling up a roll-up gives the same sums, so the batch job
aggregates the placed rows to a cube and takes the facts from that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar, labels
from ..functions.numeric import amount, as_double, exact_rate, exact_sum, percent
from ..operators.dedup import keep_first, keep_last
from ..operators.lookup import Known, spread_lookup
from ..operators.numbering import dense_index, frequency_index

NOTHING_KNOWN = Known()
#: A lookup table of two numbers a row is broadcast up to this size, a few tens of megabytes.
NARROW_ROWS = 500_000
UNDEFINED_BAND = len(labels.AGE_BANDS)
FILE_ORDER = ("file_order",)


def branch_positions(branches: DataFrame) -> DataFrame:
    return dense_index(branches.select("branch_id"), "branch_id", "branch_ix")


def type_positions(rows: DataFrame) -> DataFrame:
    """Transaction types by frequency; ``rows`` has ``tx_type`` and ``cnt``."""
    counts = rows.groupBy("tx_type").agg(F.sum("cnt").alias("cnt"))
    return frequency_index(counts, "tx_type", "cnt", "type_ix").select("tx_type", "type_ix")


def _band_ix() -> Column:
    return labels.age_band_index(F.col("age_band")).alias("band_ix")


def _known_band() -> Column:
    return F.coalesce("band_ix", F.lit(UNDEFINED_BAND))


def _totals(names: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names]


# --- dimensions ------------------------------------------------------------------------------------------------

def account_dimension(
    accounts: DataFrame, clients: DataFrame, branch_ix: DataFrame, known: Known = NOTHING_KNOWN
) -> DataFrame:
    """Account -> branch position and age band of its client."""
    rows = accounts.select("account_id", "client_id", "branch_id")
    banded = spread_lookup(
        rows, clients.select("client_id", _band_ix()), "client_id", ["account_id"], **known.about("clients", ("accounts", "client_id"))
    )
    placed = spread_lookup(
        banded, branch_ix, "branch_id", ["account_id"], detect_in=rows, **known.about("branches", ("accounts", "branch_id"))
    )
    return placed.select("account_id", "branch_ix", "band_ix")


def primary_accounts(accounts: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """First account of each client in file order."""
    rows = accounts.filter(F.col("client_id").isNotNull()).select("client_id", "branch_id", "balance", *order)
    return keep_first(rows, ["client_id"], order).drop(*order)


def client_dimension(
    clients: DataFrame, accounts: DataFrame, branch_ix: DataFrame, order: Sequence[str] = FILE_ORDER, known: Known = NOTHING_KNOWN
) -> DataFrame:
    """Client -> band, join year, and branch, branch position and balance of the primary account."""
    rows = clients.select("client_id", _band_ix(), calendar.year(F.col("joined_at")).alias("joined_year"))
    # one row per client on both sides
    placed = rows.join(primary_accounts(accounts, order), "client_id", "left")
    return spread_lookup(
        placed, branch_ix, "branch_id", ["client_id"], detect_in=accounts, **known.about("branches", ("accounts", "branch_id"))
    )


def employee_branches(employee_branch: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Employee -> branch; the last row of an employee wins."""
    last = keep_last(employee_branch, ["employee_id"], order)
    return last.select("employee_id", F.col("branch_id").alias("employee_branch_id"))


# --- transactions ----------------------------------------------------------------------------------------------

TX_CUBE = ("year", "month", "branch_ix", "band_ix", "tx_type")


def placed_transactions(
    transactions: DataFrame, accounts: DataFrame, clients: DataFrame, branch_ix: DataFrame, known: Known = NOTHING_KNOWN
) -> DataFrame:
    """Transactions with branch position and band: the one join of the transaction table."""
    rows = transactions.select(
        "account_id", "tx_id", "tx_type",
        calendar.year(F.col("tx_at")).alias("year"), calendar.month(F.col("tx_at")).alias("month"),
        F.lit(1).cast("bigint").alias("cnt"), F.abs(amount(transactions, "amount")).alias("vol"),
    ).filter("year > 0")
    account_dim = account_dimension(accounts, clients, branch_ix, known)
    joined = spread_lookup(
        rows, account_dim, "account_id", ["tx_id"], sized_by=accounts, **known.about("accounts", ("transactions", "account_id"))
    )
    return joined.select("year", "month", "branch_ix", _known_band().alias("band_ix"), "tx_type", "cnt", "vol")


def tx_cube(
    transactions: DataFrame, accounts: DataFrame, clients: DataFrame, branch_ix: DataFrame, known: Known = NOTHING_KNOWN
) -> DataFrame:
    placed = placed_transactions(transactions, accounts, clients, branch_ix, known)
    return placed.groupBy(*TX_CUBE).agg(*_totals(["cnt", "vol"]))


def _tx_fact(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*_totals(["cnt", "vol"])).withColumn("vol", as_double(F.col("vol")))


def tx_evolution(rows: DataFrame) -> DataFrame:
    """Monthly counts and volume; an unknown branch stays as a null position."""
    return _tx_fact(rows, ["year", "month", "branch_ix", "band_ix"])


def tx_by_type(rows: DataFrame, type_ix: DataFrame) -> DataFrame:
    """Yearly counts and volume per type; unknown branches and types drop out. Positions are attached to the groups."""
    known = rows.dropna(subset=["branch_ix", "tx_type"])
    grouped = known.groupBy("year", "branch_ix", "band_ix", "tx_type").agg(*_totals(["cnt", "vol"]))
    return grouped.join(type_ix, "tx_type").select(
        "year", "branch_ix", "band_ix", "type_ix", "cnt", as_double(F.col("vol")).alias("vol")
    )


def withdrawals(rows: DataFrame, text: str = labels.WITHDRAWAL_TEXT) -> DataFrame:
    taken = rows.filter(labels.contains_text(F.col("tx_type"), text)).dropna(subset=["branch_ix"])
    return _tx_fact(taken, ["year", "month", "branch_ix", "band_ix"]).drop("cnt")


# --- clients ---------------------------------------------------------------------------------------------------

def client_facts(
    client_dim: DataFrame, branches: DataFrame, states: Sequence[str] = labels.ACTIVE_STATES
) -> DataFrame:
    """Clients and balance by branch, band, state and join year; states outside the list drop out."""
    by_branch = (
        client_dim.dropna(subset=["branch_ix", "joined_year"])
        .groupBy("branch_id", "branch_ix", "band_ix", "joined_year")
        .agg(F.count(F.lit(1)).alias("cnt"), as_double(exact_sum(amount(client_dim, "balance"))).alias("balance"))
    )
    state_ix = branches.select("branch_id", labels.ordinal(F.col("state"), states).alias("state_ix"))
    return by_branch.join(state_ix.dropna(subset=["state_ix"]), "branch_id").select(
        "branch_ix", "band_ix", "state_ix", "joined_year", "cnt", "balance"
    )


# --- proposals -------------------------------------------------------------------------------------------------

PROPOSAL_SUMS = ("cnt", "proposed", "rate_total", "installments_total", "financed", "down")
PROPOSAL_CUBE = ("year", "branch_ix", "band_ix", "status_ix", "rate_bin", "installments")


def placed_proposals(
    proposals: DataFrame,
    client_dim: DataFrame,
    employee_branch: DataFrame,
    branch_ix: DataFrame,
    bin_edges: Sequence[float] = labels.RATE_BIN_EDGES,
    order: Sequence[str] = FILE_ORDER,
    sized_by: DataFrame | None = None,
    known: Known = NOTHING_KNOWN,
) -> DataFrame:
    """Proposals with band and the position of the client's branch, else of the employee's; without either they drop out.

    ``sized_by`` is the client table when ``client_dim`` is not stored.
    """
    rows = proposals.select(
        "proposal_id", "client_id", "employee_id", "installments",
        F.coalesce("year", F.lit(0)).alias("year"),
        labels.status_code(F.col("status")).alias("status_ix"),
        labels.bin_index(percent(F.col("monthly_rate")), bin_edges).alias("rate_bin"),
        F.lit(1).cast("bigint").alias("cnt"),
        F.col("proposed_amount").alias("proposed"),
        exact_rate(F.col("monthly_rate")).alias("rate_total"),
        F.col("installments").cast("bigint").alias("installments_total"),
        F.col("financed_amount").alias("financed"),
        F.col("down_payment").alias("down"),
    )
    by_client = client_dim.select("client_id", "band_ix", F.col("branch_ix").alias("_client_ix"))
    by_employee = (
        employee_branches(employee_branch, order)
        .join(branch_ix.toDF("employee_branch_id", "_employee_ix"), "employee_branch_id")
        .select("employee_id", "_employee_ix")
    )
    placed = spread_lookup(
        rows, by_client, "client_id", ["proposal_id"], sized_by=sized_by, detect_in=proposals,
        **known.about("clients", ("proposals", "client_id")),
    )
    placed = spread_lookup(
        placed, by_employee, "employee_id", ["proposal_id"], sized_by=employee_branch, detect_in=proposals,
        small_rows=NARROW_ROWS, **known.about("employee_branch", ("proposals", "employee_id")),
    )
    return (
        placed.withColumn("branch_ix", F.coalesce("_client_ix", "_employee_ix")).dropna(subset=["branch_ix"])
        .select(*[_known_band().alias("band_ix") if c == "band_ix" else c for c in (*PROPOSAL_CUBE, *PROPOSAL_SUMS)])
    )


def proposal_cube(placed: DataFrame) -> DataFrame:
    return placed.groupBy(*PROPOSAL_CUBE).agg(*_totals(PROPOSAL_SUMS))


def proposal_facts(rows: DataFrame) -> DataFrame:
    """Counts and sums by year, branch, band and status; rates are summed, so readers divide by ``cnt``."""
    grouped = rows.groupBy("year", "branch_ix", "band_ix", "status_ix").agg(*_totals(PROPOSAL_SUMS))
    return grouped.select(
        "year", "branch_ix", "band_ix", "status_ix", "cnt", as_double(F.col("proposed")).alias("proposed"),
        as_double(F.col("rate_total")).alias("rate_total"), F.col("installments_total").alias("installments"),
        as_double(F.col("financed")).alias("financed"), as_double(F.col("down")).alias("down"),
    )


def rate_histogram(rows: DataFrame, clamp_to_zero: bool = False) -> DataFrame:
    """Proposals per rate bin and installments; rates outside the bins keep a null bin unless clamped into bin 0."""
    rate_bin = F.coalesce("rate_bin", F.lit(0)) if clamp_to_zero else F.col("rate_bin")
    return rows.groupBy("year", "branch_ix", "band_ix", rate_bin.alias("rate_bin"), "installments").agg(
        F.sum("cnt").alias("cnt")
    )
