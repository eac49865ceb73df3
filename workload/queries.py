"""Registered queries: every operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystrata.functions import calendar, casting, labels, layouts, numeric
from tallystrata.operators import dedup, lookup, numbering, stats
from tallystrata.plans import analytics, dims, facts, quality, temporal
from tallystrata.session import configure
from tallystrata.sources.scratch import stored
from tallystrata.sources.tables import Field, Reference, Table

from . import raw
from .bank import APPROVED, AS_OF, STATES, WITHDRAWAL, YEARS, Bank, busy_day

FIRST, LAST = "1996-01-01", "2000-12-31"

_QUERIES: dict[str, Callable[[Bank], DataFrame]] = {}


def query(build: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build):
        return lambda spark, sf_dir: build(Bank(configure(spark), sf_dir))
    return {name: bound(build) for name, build in _QUERIES.items()}


# --- transactions ----------------------------------------------------------------------------------------------

@query
def annual_yoy(b: Bank) -> DataFrame:
    return analytics.annual_change(b.transactions())


@query
def tx_kpis(b: Bank) -> DataFrame:
    return analytics.tx_kpis(b.transactions())


@query
def tx_by_type_share(b: Bank) -> DataFrame:
    return analytics.tx_by_kind(b.transactions())


@query
def month_profile(b: Bank) -> DataFrame:
    return analytics.month_profile(b.transactions())


@query
def top_accounts(b: Bank) -> DataFrame:
    return analytics.top_accounts(b.transactions())


# --- customers -------------------------------------------------------------------------------------------------

@query
def client_kpis(b: Bank) -> DataFrame:
    kinds = {"automobile": "AUTOMOBILE", "building": "BUILDING"}
    return analytics.client_kpis(b.clients(), AS_OF, kinds)


@query
def age_bands_sql(b: Bank) -> DataFrame:
    return analytics.clients_by_age_band(b.clients(), AS_OF)


@query
def age_bands_sql_undefined(b: Bank) -> DataFrame:
    return analytics.clients_by_age_band(b.clients(), AS_OF, null_label="undefined")


@query
def age_bands_decimal(b: Bank) -> DataFrame:
    band = F.col("age_band")
    return b.silver_clients().select("client_id", "age_years", "age_band", labels.age_band_index(band).alias("band_ix"))


@query
def client_balance_top(b: Bank) -> DataFrame:
    return analytics.client_balances(b.clients(), b.accounts())


@query
def url_tail_top(b: Bank) -> DataFrame:
    return analytics.clients_by_address_tail(b.table("pages"), k=10, address="url")


# --- credit ----------------------------------------------------------------------------------------------------

@query
def credit_kpis(b: Bank) -> DataFrame:
    return analytics.credit_kpis(b.proposals())


@query
def status_share(b: Bank) -> DataFrame:
    return analytics.status_share(b.proposals())


@query
def tenor_rate(b: Bank) -> DataFrame:
    return analytics.rate_by_tenor(b.proposals())


@query
def top_employees(b: Bank) -> DataFrame:
    return analytics.top_employees(b.proposals(), b.employees(), APPROVED)


# --- monthly index ---------------------------------------------------------------------------------------------

@query
def index_running_sum(b: Bank) -> DataFrame:
    return analytics.index_running(b.index(), FIRST, LAST)


@query
def index_running_compound(b: Bank) -> DataFrame:
    running = analytics.index_running(b.index(), FIRST, LAST, compound=True)
    return running.withColumn("running_pct", numeric.half_up(F.col("running_pct"), 6))


@query
def withdrawals_vs_index(b: Bank) -> DataFrame:
    return analytics.withdrawals_vs_index(b.transactions(), b.index(), WITHDRAWAL)


@query
def credit_vs_index(b: Bank) -> DataFrame:
    return analytics.credit_vs_index(b.proposals(), b.index(), APPROVED)


@query
def index_withdrawal_pairs(b: Bank) -> DataFrame:
    # orders before July 1996 get no type: their index months stay, with a null volume
    late = b.transactions().withColumn("tx_type", F.when(F.col("tx_at") >= F.lit("1996-07-01").cast("date"), F.col("tx_type")))
    pairs = analytics.index_withdrawal_pairs(late, b.index(), FIRST, LAST, WITHDRAWAL)
    return pairs.select(
        "month_start",
        numeric.as_double(F.col("month_rate")).alias("month_rate"), numeric.as_double(F.col("volume")).alias("volume"),
    )


@query
def index_corr(b: Bank) -> DataFrame:
    corr = analytics.index_withdrawal_corr(b.transactions(), b.index(), FIRST, LAST, WITHDRAWAL)
    return corr.select(numeric.half_up(F.col("correlation"), 6).alias("correlation"))


@query
def corr_constant_side(b: Bank) -> DataFrame:
    flat = b.table("customer").select("c_acctbal", F.lit(0.004).alias("flat"))
    return stats.safe_corr(flat, "c_acctbal", "flat", "correlation")


@query
def index_slice(b: Bank) -> DataFrame:
    monthly = b.index().select(
        calendar.year(F.col("month_start")).alias("year"), calendar.month(F.col("month_start")).alias("month"),
        numeric.as_double(numeric.percent(F.col("month_rate"))).alias("month_pct"),
        numeric.as_double(numeric.percent(F.col("month_rate") * 12)).alias("pct_12m"),
    )
    return temporal.index_slice(monthly, 1997, 1999)


# --- facts -----------------------------------------------------------------------------------------------------

def _placed(b: Bank) -> DataFrame:
    branch_ix = facts.branch_positions(b.branches())
    return facts.placed_transactions(b.transactions(), b.accounts(), b.silver_clients(), branch_ix)


@query
def fact_tx_evolution(b: Bank) -> DataFrame:
    return facts.tx_evolution(_placed(b))


@query
def fact_tx_type(b: Bank) -> DataFrame:
    counts = b.transactions().groupBy("tx_type").agg(F.count(F.lit(1)).alias("cnt"))
    return facts.tx_by_type(_placed(b), facts.type_positions(counts))


@query
def fact_withdrawals(b: Bank) -> DataFrame:
    return facts.withdrawals(_placed(b), WITHDRAWAL)


@query
def fact_clients(b: Bank) -> DataFrame:
    dim = facts.client_dimension(b.silver_clients(), b.accounts(), facts.branch_positions(b.branches()))
    return facts.client_facts(dim, b.branches(), STATES)


def _placed_proposals(b: Bank) -> DataFrame:
    branch_ix = facts.branch_positions(b.branches())
    dim = facts.client_dimension(b.silver_clients(), b.accounts(), branch_ix)
    return facts.placed_proposals(
        b.proposals(with_client=True), dim, b.employee_branch(), branch_ix, sized_by=b.clients()
    )


@query
def fact_proposals(b: Bank) -> DataFrame:
    return facts.proposal_facts(_placed_proposals(b))


@query
def rate_histogram(b: Bank) -> DataFrame:
    return facts.rate_histogram(_placed_proposals(b))


@query
def proposal_cube(b: Bank) -> DataFrame:
    """The stored roll-up from which the job takes both proposal facts; here the histogram taken from it."""
    return facts.rate_histogram(facts.proposal_cube(_placed_proposals(b)))


@query
def rate_histogram_clamped(b: Bank) -> DataFrame:
    return facts.rate_histogram(_placed_proposals(b), clamp_to_zero=True)


# --- daily series ----------------------------------------------------------------------------------------------

def _daily(b: Bank) -> DataFrame:
    return temporal.daily_series(b.transactions())


def _scoped(b: Bank) -> DataFrame:
    daily = _daily(b)
    return temporal.scoped(temporal.clean_days(daily, busy_day(daily)), YEARS)


@query
def daily_series(b: Bank) -> DataFrame:
    return _daily(b).withColumn("vol", numeric.as_double(F.col("vol")))


@query
def event_daily_series(b: Bank) -> DataFrame:
    daily = temporal.daily_series(b.table("events"), "ts", "value")
    return daily.withColumn("vol", numeric.as_double(F.col("vol")))


@query
def burst_days(b: Bank) -> DataFrame:
    daily = _daily(b)
    return temporal.burst_days(daily, busy_day(daily)).withColumn("vol", numeric.as_double(F.col("vol")))


@query
def burst_summary(b: Bank) -> DataFrame:
    daily = _daily(b)
    return temporal.burst_summary(daily, busy_day(daily)).select(
        "burst_days", "clean_tx", "total_tx", F.array_join("burst_dates", ",").alias("burst_dates")
    )


@query
def seasonality_quarter(b: Bank) -> DataFrame:
    return temporal.seasonality_by_quarter(_scoped(b))


@query
def seasonality_weekday(b: Bank) -> DataFrame:
    return temporal.seasonality_by_weekday(_scoped(b))


@query
def welch_month_flag(b: Bank) -> DataFrame:
    return temporal.month_flag_test(_scoped(b))


@query
def welch_parity(b: Bank) -> DataFrame:
    return temporal.month_parity_test(_scoped(b))


# --- deduplication ---------------------------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


def _lines(b: Bank) -> tuple[DataFrame, list[str]]:
    lines = b.table("lineitem").withColumns(
        {c: F.col(c) + F.lit(0.0) for c in ("l_discount", "l_tax")}
    )
    first = ["l_shipdate", "l_partkey", "l_suppkey"]
    return lines, first + [c for c in lines.columns if c not in first + LINE_KEY]


@query
def dedup_keep_first(b: Bank) -> DataFrame:
    lines, order = _lines(b)
    return dedup.keep_first(lines, LINE_KEY, order)


@query
def dedup_keep_last(b: Bank) -> DataFrame:
    lines, order = _lines(b)
    return dedup.keep_last(lines, LINE_KEY, order)


@query
def distinct_rows(b: Bank) -> DataFrame:
    return dedup.distinct_rows(b.table("lineitem"))


@query
def first_tx_per_account(b: Bank) -> DataFrame:
    """First row per client in a given order, over a key that repeats; the rule of the primary account."""
    rows = b.table("orders").select(
        F.col("o_custkey").alias("client_id"), F.col("o_orderkey").alias("branch_id"),
        F.col("o_totalprice").alias("balance"), F.col("o_orderkey").alias("file_order"),
    )
    return facts.primary_accounts(rows)


@query
def last_branch_per_employee(b: Bank) -> DataFrame:
    """Last row wins: the branch an employee is mapped to."""
    lines = b.table("lineitem")
    pairs = lines.select(
        F.col("l_suppkey").alias("employee_id"), F.col("l_partkey").alias("branch_id"),
        F.struct("l_shipdate", "l_partkey").alias("file_order"),
    )
    return facts.employee_branches(pairs)


# --- joins -----------------------------------------------------------------------------------------------------

@query
def account_dimension(b: Bank) -> DataFrame:
    return facts.account_dimension(b.accounts(), b.silver_clients(), facts.branch_positions(b.branches()))


@query
def client_dimension(b: Bank) -> DataFrame:
    dim = facts.client_dimension(b.silver_clients(), b.accounts(), facts.branch_positions(b.branches()))
    return dim.withColumn("balance", numeric.as_double(F.col("balance")))


@query
def spread_lookup_hot(b: Bank) -> DataFrame:
    """Events against a lookup of their few types: every key is hot and is cut into slices."""
    kinds = b.table("events").groupBy("event_type").agg(F.min("event_id").alias("first_id"))
    rows = b.table("events").select("event_id", F.when(F.col("value") >= 1, F.col("event_type")).alias("event_type"))
    return lookup.spread_lookup(rows, kinds, "event_type", ["event_id"], slices=64, small_rows=1)


@query
def null_matching_join(b: Bank) -> DataFrame:
    left = b.accounts().groupBy("branch_id").agg(F.count(F.lit(1)).alias("accounts"))
    right = b.accounts().groupBy("branch_id").agg(numeric.as_double(numeric.money_sum(F.col("balance"))).alias("balance"))
    return lookup.null_matching_lookup(left, right, "branch_id", ["accounts"])


# --- dimensions ------------------------------------------------------------------------------------------------

@query
def headcount(b: Bank) -> DataFrame:
    return dims.headcount(b.branches().select("branch_id", "short_name"), b.employee_branch())


@query
def branch_dimension(b: Bank) -> DataFrame:
    branches = b.branches()
    return dims.branch_dimension(branches, b.employee_branch(), facts.branch_positions(branches))


@query
def grand_totals(b: Bank) -> DataFrame:
    return dims.grand_totals(b.clients(), b.accounts(), b.employees(), b.branches())


@query
def dense_index(b: Bank) -> DataFrame:
    return numbering.dense_index(stored(b.table("part").select("p_name").distinct()), "p_name", "name_ix")


@query
def dense_index_ranges(b: Bank) -> DataFrame:
    """The same numbering on the path for large dimensions."""
    return numbering.dense_index(b.table("customer").select("c_name"), "c_name", "name_ix", single_task_rows=10)


@query
def frequency_index(b: Bank) -> DataFrame:
    counts = b.table("part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("cnt"))
    return numbering.frequency_index(counts, "p_brand", "cnt", "brand_ix")


# --- typing, calendar, labels ----------------------------------------------------------------------------------

@query
def calendar_parts(b: Bank) -> DataFrame:
    at = F.col("o_orderdate")
    return b.table("orders").select(
        "o_orderkey", calendar.year(at).alias("year"), calendar.quarter(at).alias("quarter"),
        calendar.month(at).alias("month"), calendar.weekday(at).alias("weekday"), calendar.day(at).alias("day"),
        calendar.month_start(at).alias("month_start"), calendar.iso_date(at).alias("iso"),
        at.cast("date").isNotNull().alias("dated"),
        calendar.month(at).isin(*labels.MONTHS_WITH_R).alias("in_months"), (calendar.month(at) % 2 == 0).alias("even_month"),
    )


@query
def completed_ages(b: Bank) -> DataFrame:
    birth = F.to_date("o_orderdate")
    return b.table("orders").select(
        "o_orderkey",
        calendar.completed_years(birth, "2023-02-28").alias("age_feb"),
        calendar.completed_years(birth, "2024-02-29").alias("age_leap"),
        calendar.decimal_age(birth, AS_OF).alias("age_decimal"),
    )


@query
def typed_numbers(b: Bank) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("R$ "), price))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("N/A")).otherwise(price)
    )
    clean = casting.missing_to_null(text)
    return b.table("orders").select(
        "o_orderkey", numeric.as_double(casting.to_money(clean)).alias("money"),
        numeric.as_double(casting.to_rate(clean)).alias("rate"), casting.to_int(F.col("o_orderpriority").substr(1, 1)).alias("whole"),
        clean.isNull().alias("is_missing"),
    )


@query
def typed_timestamps(b: Bank) -> DataFrame:
    """Mixed spellings of one instant per row; text that is no date gives null."""
    return b.table("orders").select(
        "o_orderkey", casting.to_utc_timestamp_mixed(raw.timestamp_text(F.col("o_orderdate"))).cast("timestamp_ntz").alias("at")
    )


@query
def status_codes(b: Bank) -> DataFrame:
    return b.proposals().groupBy("status", labels.status_code(F.col("status")).alias("status_ix")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def text_labels(b: Bank) -> DataFrame:
    name = F.concat(F.lit("Agência "), F.col("n_name"), F.lit(" "))
    region = F.col("r_name")
    branches = b.table("nation").join(b.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return branches.select(
        "n_nationkey", labels.without(name, labels.BRANCH_NAME_NOISE).alias("short_name"),
        labels.ordinal(region, STATES).alias("state_ix"),
        labels.full_name(F.when(region != "ASIA", region), F.col("n_name")).alias("full_name"),
        labels.last_part(F.concat_ws("/ ", region, "n_name"), "/").alias("tail"),
        labels.last_part(F.concat_ws("/ ", region, "n_name"), "/", trimmed=True).alias("tail_trimmed"),
    )


@query
def month_numbers(b: Bank) -> DataFrame:
    """Month names to numbers; English names that differ from the fixed list give null."""
    name = F.lower(F.date_format("o_orderdate", "MMM"))
    return b.table("orders").groupBy(name.alias("name"), labels.month_number(name).alias("number")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def rate_bins(b: Bank) -> DataFrame:
    pct = numeric.percent(F.col("l_discount") * 0.25)
    return b.table("lineitem").groupBy(
        numeric.as_double(pct).alias("pct"), labels.bin_index(pct, labels.RATE_BIN_EDGES).alias("bin")
    ).agg(F.count(F.lit(1)).alias("rows"))


@query
def rounding_rules(b: Bank) -> DataFrame:
    half = F.col("o_totalprice").cast("decimal(14,2)") * F.lit("0.5").cast("decimal(2,1)")
    return b.table("orders").select(
        "o_orderkey",
        numeric.half_up(half, 2).cast("double").alias("half_up"),
        numeric.half_even(half, 2).cast("double").alias("half_even"),
        numeric.ratio(F.lit(1).cast("double"), (F.col("o_custkey") % 3).cast("double")).alias("guarded"),
    )


# --- checks ----------------------------------------------------------------------------------------------------

@query
def dq_unique_key(b: Bank) -> DataFrame:
    return quality.duplicate_count(b.table("lineitem"), *LINE_KEY)


@query
def dq_orphans(b: Bank) -> DataFrame:
    """Orders whose customer has no account with a branch; customers without one are missing on the parent side."""
    placed = b.accounts().filter("branch_id is not null")
    return lookup.orphan_rows(b.transactions(), F.col("account_id"), placed, F.col("account_id"))


@query
def dq_nulls(b: Bank) -> DataFrame:
    return quality.null_counts(b.silver_clients().join(b.accounts(), "client_id"), ["birth_date", "branch_id", "joined_at"])


@query
def dq_balances(b: Bank) -> DataFrame:
    return quality.balance_profile(b.accounts().withColumn("balance", F.when(F.col("balance") < 9000, F.col("balance"))))


@query
def dq_totals_match(b: Bank) -> DataFrame:
    evolution = facts.tx_evolution(_placed(b))
    return quality.totals_gap(b.transactions(), evolution)


@query
def dq_constraints(b: Bank) -> DataFrame:
    names = ("nation", "customer", "orders", "lineitem", "supplier", "documents", "labels")
    frames = {n: b.table(n) for n in names}
    frames["customer"] = frames["customer"].withColumn("c_nationkey", F.when(F.col("c_acctbal") >= 500, F.col("c_nationkey")))
    key = lambda n: Field(n, n, "bigint", required=True)
    tables = [
        Table("nation", "", (key("n_nationkey"),), "n_nationkey"),
        Table("customer", "", (key("c_custkey"), key("c_nationkey")), "c_custkey"),
        Table("orders", "", (key("o_orderkey"), key("o_custkey")), "o_orderkey"),
        Table("lineitem", "", (key("l_orderkey"), Field("", "l_returnflag", "string", length=1)), "l_orderkey"),
        Table("documents", "", (Field("", "text", "string", length=1000),), "doc_id"),
    ]
    references = [
        Reference("customer", "c_nationkey", "nation", "n_nationkey"),
        Reference("orders", "o_custkey", "customer", "c_custkey"),
        Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
        Reference("lineitem", "l_partkey", "supplier", "s_suppkey"),
        Reference("documents", "doc_id", "labels", "doc_id"),
    ]
    return quality.constraint_violations(frames, tables, references)


@query
def row_counts(b: Bank) -> DataFrame:
    names = ("nation", "customer", "supplier", "orders", "lineitem", "events", "pages")
    return analytics.row_counts({n: b.table(n) for n in names})


# --- raw files, layers, job ------------------------------------------------------------------------------------

@query
def bronze_transactions(b: Bank) -> DataFrame:
    """Orders written as raw text and ingested again: names as they came, ordinal per file, nothing rejected."""
    return raw.bronze_transactions(b)


@query
def silver_transactions(b: Bank) -> DataFrame:
    return raw.silver_table(b, "transactions")


@query
def silver_branches(b: Bank) -> DataFrame:
    return raw.silver_table(b, "branches")


@query
def silver_clients(b: Bank) -> DataFrame:
    return raw.silver_table(b, "clients")


@query
def silver_accounts(b: Bank) -> DataFrame:
    return raw.silver_table(b, "accounts", "file_order")


@query
def silver_proposals(b: Bank) -> DataFrame:
    return raw.silver_table(b, "proposals", "proposal_id")


@query
def silver_employees(b: Bank) -> DataFrame:
    return raw.silver_table(b, "employees")


@query
def silver_employee_branch(b: Bank) -> DataFrame:
    return raw.silver_table(b, "employee_branch", "file_order")


@query
def silver_price_index(b: Bank) -> DataFrame:
    return raw.silver_table(b, "price_index")


@query
def typed_load(b: Bank) -> DataFrame:
    return raw.typed_transactions(b)


@query
def job_tx_evolution(b: Bank) -> DataFrame:
    """The whole job from raw files; returns the published monthly fact."""
    return raw.job(b).gold("fact_tx_evolucao")


@query
def job_fact_totals(b: Bank) -> DataFrame:
    """The whole job from raw files; returns rows, counts and amounts of the five published facts."""
    return raw.fact_totals(raw.job(b))


@query
def job_report(b: Bank) -> DataFrame:
    """The whole job from raw files; returns the size of each section of the published report."""
    return raw.report_sizes(raw.job(b))


@query
def job_report_values(b: Bank) -> DataFrame:
    """The whole job from raw files; returns every value of the nine sections of the published report."""
    return raw.report_values(raw.job(b))


@query
def job_checks(b: Bank) -> DataFrame:
    """The checks, from what the writes of the whole job observed, and of a job that stops before its last layer."""
    return raw.checked(b)


@query
def bronze_line_breaks(b: Bank) -> DataFrame:
    return raw.line_breaks(b)


@query
def bronze_rejects(b: Bank) -> DataFrame:
    return raw.rejects(b)


@query
def bronze_latin1(b: Bank) -> DataFrame:
    return raw.mixed_encodings(b)


@query
def typed_dates(b: Bank) -> DataFrame:
    """Dates in the layout that most values of their column have."""
    return layouts.dated(raw.spelled_dates(b), {c: "date" for c in ("day_first", "year_first", "mixed")})


@query
def typed_dates_lost(b: Bank) -> DataFrame:
    return raw.lost_dates(b)


@query
def typed_money_wide(b: Bank) -> DataFrame:
    return raw.wide_amounts(b)


@query
def typed_load_counts(b: Bank) -> DataFrame:
    return raw.typed_tables(b)
