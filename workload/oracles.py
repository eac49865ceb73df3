"""Independent SQL for the registered queries, in DuckDB's dialect.

Means are rounded in integer arithmetic, so that ties do not depend on binary fractions.
"""

from __future__ import annotations

from .bank import AS_OF

ORACLES: dict[str, str] = {}


def _mean(total: str, count: str, unit_digits: int, places: int) -> str:
    """Half-up rounded total / count, where total is an integer in units of 10^-unit_digits (non-negative)."""
    scale = 10 ** (places - unit_digits) if places >= unit_digits else 1
    divide = 10 ** max(unit_digits - places, 0)
    return f"CAST((2 * {scale} * ({total}) + {divide} * ({count})) // (2 * {divide} * ({count})) AS DOUBLE) / {10 ** places}.0"


def _even(total: str, count: str, unit_digits: int, places: int) -> str:
    """Half-even variant of _mean."""
    scale = 10 ** (places - unit_digits) if places >= unit_digits else 1
    divide = 10 ** max(unit_digits - places, 0)
    top, bottom = f"(2 * {scale} * ({total}) + {divide} * ({count}))", f"(2 * {divide} * ({count}))"
    whole = f"({top} // {bottom})"
    return (
        f"CAST(CASE WHEN {top} % {bottom} = 0 AND {whole} % 2 = 1 THEN {whole} - 1 ELSE {whole} END AS DOUBLE)"
        f" / {10 ** places}.0"
    )


def _cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def _money(column: str) -> str:
    return f"CAST(coalesce(sum(CAST({column} AS DECIMAL(14,2))), 0) AS DOUBLE)"


CLIENTS = f"""
clients AS (
  SELECT c_custkey AS client_id, c_name, c_mktsegment, c_nationkey, c_acctbal,
         CASE WHEN c_acctbal < 9900 THEN DATE '1940-01-01' + CAST((c_custkey * 37) % 24000 AS INTEGER) END AS birth,
         DATE '2010-01-01' + CAST((c_custkey * 13) % 4000 AS INTEGER) AS joined,
         CASE WHEN c_acctbal >= 500 THEN CAST(c_nationkey AS BIGINT) END AS branch_id
  FROM customer
),
aged AS (
  SELECT *, round(date_diff('day', birth, DATE '{AS_OF}') / 365.25, 1) AS age_years,
         2024 - year(birth) - CASE WHEN 101 < month(birth) * 100 + day(birth) THEN 1 ELSE 0 END AS full_years
  FROM clients
),
banded AS (
  SELECT *, CASE WHEN age_years IS NULL THEN 3 WHEN age_years < 25 THEN 0 WHEN age_years < 60 THEN 1 ELSE 2 END AS band_ix
  FROM aged
),
branch_ix AS (SELECT n_nationkey AS branch_id, CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS branch_ix FROM nation)
"""

PROPOSALS = """
proposals AS (
  SELECT l_orderkey, l_suppkey AS employee_id, l_shipdate, l_tax, l_extendedprice, l_quantity, l_discount * 0.25 AS rate,
         CAST(round(l_discount * 100) AS BIGINT) AS discount_pct,
         CAST(l_quantity * 2 AS INTEGER) AS installments,
         CASE WHEN l_returnflag = 'A' THEN 'Aprovado' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Em análise'
              WHEN l_returnflag = 'N' THEN 'Validação' WHEN l_linestatus = 'O' THEN 'Enviada' END AS status
  FROM lineitem
)
"""

INDEX = """
monthly_index AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
         (2 * 10000 * sum(CAST(round(l_tax * 100) AS BIGINT)) + count(*)) // (2 * count(*)) AS micro
  FROM lineitem GROUP BY 1
)
"""

# --- transactions

ORACLES["annual_yoy"] = """
WITH annual AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS HUGEINT) AS cents
  FROM orders GROUP BY 1
), lagged AS (SELECT *, lag(cents) OVER (ORDER BY year) AS before FROM annual)
SELECT year, cents / 100.0 AS volume, before / 100.0 AS previous_volume,
       sign(cents - before) * CAST((2 * 10000 * abs(cents - before) + before) // (2 * before) AS DOUBLE) / 100.0 AS change_pct
FROM lagged
"""

ORACLES["tx_kpis"] = f"""
SELECT count(*) AS transactions, {_money('o_totalprice')} AS volume,
       {_mean('sum(' + _cents('o_totalprice') + ')', 'count(*)', 2, 2)} AS mean_ticket,
       min(o_orderdate) AS first_at, max(o_orderdate) AS last_at
FROM orders
"""

ORACLES["tx_by_type_share"] = f"""
SELECT o_orderpriority AS tx_type, count(*) AS transactions, {_money('o_totalprice')} AS volume,
       {_mean('100 * count(*)', 'sum(count(*)) OVER ()', 0, 2)} AS share_pct
FROM orders GROUP BY 1
"""

ORACLES["month_profile"] = f"""
SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS transactions, {_money('o_totalprice')} AS volume,
       {_mean('sum(' + _cents('o_totalprice') + ')', 'count(*)', 2, 2)} AS mean_ticket
FROM orders GROUP BY 1
"""

ORACLES["top_accounts"] = f"""
SELECT o_custkey AS account_id, count(*) AS transactions, {_money('o_totalprice')} AS volume
FROM orders GROUP BY 1 ORDER BY volume DESC, account_id LIMIT 10
"""

# --- customers

ORACLES["client_kpis"] = f"""
WITH {CLIENTS}
SELECT count(*) AS clients, count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS automobile,
       count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building,
       {_mean('sum(full_years)', 'count(full_years)', 0, 1)} AS mean_age
FROM aged
"""


def _bands(null_band: str) -> str:
    return f"""
WITH {CLIENTS}
SELECT CASE WHEN full_years IS NULL THEN '{null_band}' WHEN full_years < 30 THEN 'a) <30' WHEN full_years < 45 THEN 'b) 30-44'
            WHEN full_years < 60 THEN 'c) 45-59' ELSE 'd) 60+' END AS band,
       count(*) AS clients,
       CASE WHEN count(full_years) > 0 THEN {_mean('sum(full_years)', 'greatest(count(full_years), 1)', 0, 1)} END AS mean_age
FROM aged GROUP BY 1
"""


ORACLES["age_bands_sql"] = _bands("d) 60+")
ORACLES["age_bands_sql_undefined"] = _bands("undefined")

ORACLES["age_bands_decimal"] = f"""
WITH {CLIENTS}
SELECT client_id, age_years, band_ix,
       CASE band_ix WHEN 0 THEN 'Jovem (<25)' WHEN 1 THEN 'Adulto (25-59)' WHEN 2 THEN 'Idoso (60+)' ELSE 'Indefinida' END AS age_band
FROM banded
"""

ORACLES["client_balance_top"] = """
SELECT c_custkey AS client_id, replace(c_name, '#', ' ') AS name, c_acctbal AS balance, CAST(1 AS BIGINT) AS accounts
FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10
"""

ORACLES["url_tail_top"] = """
SELECT split_part(url, '/', -1) AS state_guess, count(*) AS clients
FROM pages GROUP BY 1 ORDER BY clients DESC, state_guess LIMIT 10
"""

# --- credit

MEAN_RATE = _mean("25 * sum(discount_pct)", "count(*)", 2, 2)

ORACLES["credit_kpis"] = f"""
WITH {PROPOSALS}
SELECT count(*) AS proposals, {MEAN_RATE} AS mean_rate_pct,
       {_mean('sum(installments)', 'count(*)', 0, 0)} AS mean_installments,
       {_mean('sum(' + _cents('l_extendedprice') + ')', 'count(*)', 2, 2)} AS mean_financed
FROM proposals
"""

ORACLES["status_share"] = f"""
WITH {PROPOSALS}
SELECT status, count(*) AS proposals, {_mean('100 * count(*)', 'sum(count(*)) OVER ()', 0, 2)} AS share_pct
FROM proposals GROUP BY 1
"""

ORACLES["tenor_rate"] = f"""
WITH {PROPOSALS}
SELECT CASE WHEN installments <= 12 THEN 'curto (até 12)' WHEN installments <= 36 THEN 'médio (13-36)'
            WHEN installments <= 60 THEN 'longo (37-60)' ELSE 'muito longo (60+)' END AS tenor,
       count(*) AS proposals, {MEAN_RATE} AS mean_rate_pct
FROM proposals GROUP BY 1
"""

ORACLES["top_employees"] = f"""
SELECT s_suppkey AS employee_id, replace(s_name, '#', ' ') AS name, count(*) AS proposals, {_money('l_extendedprice')} AS financed
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'A'
GROUP BY 1, 2 ORDER BY financed DESC, employee_id LIMIT 10
"""

# --- monthly index

PERIOD = "month_start BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"

ORACLES["index_running_sum"] = f"""
WITH {INDEX}
SELECT month_start, micro / 10000.0 AS month_pct,
       CAST(sum(micro) OVER (ORDER BY month_start) AS BIGINT) / 10000.0 AS running_pct
FROM monthly_index WHERE {PERIOD}
"""

ORACLES["index_running_compound"] = f"""
WITH {INDEX}
SELECT month_start, micro / 10000.0 AS month_pct,
       round((exp(sum(ln(1 + micro / 1000000.0)) OVER (ORDER BY month_start)) - 1) * 100, 6) AS running_pct
FROM monthly_index WHERE {PERIOD}
"""

ORACLES["withdrawals_vs_index"] = f"""
WITH {INDEX}, monthly AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(*) AS withdrawals, {_money('o_totalprice')} AS volume
  FROM orders WHERE o_orderpriority ILIKE '%low%' GROUP BY 1
)
SELECT monthly.month_start, withdrawals, volume, CAST((micro + 50) // 100 AS DOUBLE) / 100.0 AS index_pct
FROM monthly LEFT JOIN monthly_index USING (month_start)
"""

ORACLES["credit_vs_index"] = f"""
WITH {INDEX}, monthly AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, count(*) AS proposals, {_money('l_extendedprice')} AS volume
  FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1
)
SELECT monthly.month_start, proposals, volume, CAST((micro + 50) // 100 AS DOUBLE) / 100.0 AS index_pct
FROM monthly LEFT JOIN monthly_index USING (month_start)
"""

ORACLES["index_withdrawal_pairs"] = f"""
WITH {INDEX}
SELECT month_start, micro / 1000000.0 AS month_rate, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS volume
FROM monthly_index
LEFT JOIN orders ON CAST(date_trunc('month', o_orderdate) AS DATE) = month_start
  AND o_orderpriority ILIKE '%low%' AND o_orderdate >= DATE '1996-07-01'
WHERE {PERIOD} GROUP BY month_start, micro
"""

ORACLES["index_corr"] = f"""
WITH {INDEX}, base AS (
  SELECT month_start, micro, sum(o_totalprice) AS volume
  FROM monthly_index
  LEFT JOIN orders ON date_trunc('month', o_orderdate) = month_start AND o_orderpriority ILIKE '%low%'
  WHERE {PERIOD} GROUP BY month_start, micro
)
SELECT round(corr(micro, volume), 6) AS correlation FROM base
"""

ORACLES["corr_constant_side"] = """
SELECT CASE WHEN var_samp(flat) > 0 THEN corr(c_acctbal, flat) END AS correlation
FROM (SELECT c_acctbal, CAST(0.004 AS DOUBLE) AS flat FROM customer)
"""

ORACLES["index_slice"] = f"""
WITH {INDEX}
SELECT CAST(year(month_start) AS INTEGER) AS year, CAST(month(month_start) AS INTEGER) AS month,
       {_even('micro', '1', 4, 2)} AS month_pct, {_even('micro * 12', '1', 4, 2)} AS pct_12m
FROM monthly_index WHERE year(month_start) BETWEEN 1997 AND 1999
"""

# --- facts

TX = f"""
{CLIENTS},
tx AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, day(o_orderdate) AS day,
         branch_ix, band_ix, o_orderpriority AS tx_type, o_totalprice
  FROM orders LEFT JOIN banded ON o_custkey = client_id LEFT JOIN branch_ix USING (branch_id)
),
type_ix AS (
  SELECT tx_type, CAST(row_number() OVER (ORDER BY count(*) DESC, tx_type) - 1 AS INTEGER) AS type_ix FROM tx GROUP BY 1
)
"""

ORACLES["fact_tx_evolution"] = f"""
WITH {TX}
SELECT year, month, branch_ix, band_ix, count(*) AS cnt, {_money('o_totalprice')} AS vol FROM tx GROUP BY ALL
"""

ORACLES["fact_tx_type"] = f"""
WITH {TX}
SELECT year, branch_ix, band_ix, type_ix, count(*) AS cnt, {_money('o_totalprice')} AS vol
FROM tx JOIN type_ix USING (tx_type) WHERE branch_ix IS NOT NULL GROUP BY ALL
"""

ORACLES["fact_withdrawals"] = f"""
WITH {TX}
SELECT year, month, branch_ix, band_ix, {_money('o_totalprice')} AS vol
FROM tx WHERE branch_ix IS NOT NULL AND tx_type ILIKE '%low%' GROUP BY ALL
"""

ORACLES["fact_clients"] = f"""
WITH {CLIENTS}
SELECT branch_ix, band_ix, CAST(n_regionkey AS INTEGER) AS state_ix, CAST(year(joined) AS INTEGER) AS joined_year,
       count(*) AS cnt, {_money('c_acctbal')} AS balance
FROM banded JOIN branch_ix USING (branch_id) JOIN nation ON n_nationkey = branch_id
WHERE n_regionkey < 4 GROUP BY ALL
"""

PLACED = f"""
{CLIENTS}, {PROPOSALS},
placed AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, day(l_shipdate) AS day, coalesce(c.branch_ix, e.branch_ix) AS branch_ix, band_ix,
         CASE status WHEN 'Aprovado' THEN 1 WHEN 'Validação' THEN 2 WHEN 'Em análise' THEN 3 ELSE 0 END AS status_ix,
         CASE WHEN rate * 100 < 0.8 THEN NULL WHEN rate * 100 <= 1.0 THEN 0 WHEN rate * 100 <= 1.2 THEN 1
              WHEN rate * 100 <= 1.4 THEN 2 WHEN rate * 100 <= 1.6 THEN 3 WHEN rate * 100 <= 1.8 THEN 4
              WHEN rate * 100 <= 2.0 THEN 5 WHEN rate * 100 <= 2.2 THEN 6 WHEN rate * 100 <= 2.5 THEN 7 END AS rate_bin,
         p.*
  FROM proposals p
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN banded ON o_custkey = client_id
  LEFT JOIN branch_ix c USING (branch_id)
  LEFT JOIN supplier ON employee_id = s_suppkey
  LEFT JOIN branch_ix e ON e.branch_id = s_nationkey
)
"""

ORACLES["fact_proposals"] = f"""
WITH {PLACED}
SELECT year, branch_ix, band_ix, status_ix, count(*) AS cnt, {_money('l_extendedprice')} AS proposed,
       CAST(sum(discount_pct) * 25 AS BIGINT) / 10000.0 AS rate_total, CAST(sum(installments) AS BIGINT) AS installments,
       {_money('l_extendedprice')} AS financed, {_money('l_quantity')} AS down
FROM placed WHERE branch_ix IS NOT NULL GROUP BY ALL
"""

ORACLES["rate_histogram"] = f"""
WITH {PLACED}
SELECT year, branch_ix, band_ix, rate_bin, installments, count(*) AS cnt FROM placed WHERE branch_ix IS NOT NULL GROUP BY ALL
"""

ORACLES["proposal_cube"] = ORACLES["rate_histogram"]

ORACLES["rate_histogram_clamped"] = f"""
WITH {PLACED}
SELECT year, branch_ix, band_ix, coalesce(rate_bin, 0) AS rate_bin, installments, count(*) AS cnt
FROM placed WHERE branch_ix IS NOT NULL GROUP BY ALL
"""

# --- daily series

DAILY = """
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS cnt, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM orders GROUP BY 1
),
busy AS (SELECT sum(cnt) * 3 // (count(*) * 2) AS threshold FROM daily),
clean AS (SELECT * FROM daily WHERE cnt <= (SELECT threshold FROM busy)),
scoped AS (
  SELECT 'all' AS scope, * FROM clean
  UNION ALL SELECT CAST(year(date) AS VARCHAR), * FROM clean WHERE year(date) IN (
    SELECT year(date) FROM clean WHERE year(date) IN (1998, 1999, 2000) GROUP BY 1 HAVING count(*) > 3)
)
"""

ORACLES["daily_series"] = f"WITH {DAILY} SELECT date, cnt, cents / 100.0 AS vol FROM daily"

ORACLES["event_daily_series"] = f"""
SELECT CAST(ts AS DATE) AS date, count(*) AS cnt, {_money('value')} AS vol FROM events GROUP BY 1
"""

ORACLES["burst_days"] = f"""
WITH {DAILY} SELECT date, cnt, cents / 100.0 AS vol FROM daily WHERE cnt > (SELECT threshold FROM busy)
"""

ORACLES["burst_summary"] = f"""
WITH {DAILY}
SELECT count(*) FILTER (WHERE cnt > threshold) AS burst_days,
       CAST(sum(cnt) FILTER (WHERE cnt <= threshold) AS BIGINT) AS clean_tx, CAST(sum(cnt) AS BIGINT) AS total_tx,
       coalesce(string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) FILTER (WHERE cnt > threshold), '') AS burst_dates
FROM daily, busy
"""


def _seasonality(part: str, name: str) -> str:
    return f"""
WITH {DAILY}
SELECT scope, CAST({part} AS INTEGER) AS {name}, count(*) AS days, {_even('sum(cnt)', 'count(*)', 0, 2)} AS mean_cnt,
       CAST({_even('sum(cents)', 'count(*)', 2, 0)} AS BIGINT) AS mean_vol
FROM scoped GROUP BY ALL
"""


ORACLES["seasonality_quarter"] = _seasonality("quarter(date)", "quarter")
ORACLES["seasonality_weekday"] = _seasonality("isodow(date) - 1", "weekday")


def _integral(low: str, high: str) -> str:
    """Composite Simpson over 1000 steps of cos(x)^(df - 1)."""
    x = f"({low}) + (({high}) - ({low})) * i / 1000.0"
    weight = "CASE WHEN i IN (0, 1000) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END"
    terms = f"list_transform(range(0, 1001), lambda i: ({weight}) * pow(greatest(cos({x}), 0.0), df - 1))"
    return f"list_sum({terms}) * (({high}) - ({low})) / 3000.0"


def _welch(flag: str, value: str, unit_digits: int, places: int) -> str:
    side = lambda negate: f"FILTER (WHERE {negate}({flag}))"
    scaled = f"{value} / {10 ** unit_digits}.0"
    return f"""
WITH {DAILY}, moments AS (
  SELECT scope, count(*) {side('')} AS n1, count(*) {side('NOT ')} AS n2,
         sum({value}) {side('')} AS s1, sum({value}) {side('NOT ')} AS s2,
         avg({scaled}) {side('')} AS m1, avg({scaled}) {side('NOT ')} AS m2,
         var_samp({scaled}) {side('')} AS v1, var_samp({scaled}) {side('NOT ')} AS v2
  FROM scoped GROUP BY scope
), tested AS (
  SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
         pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df
  FROM moments
), angled AS (
  SELECT *, atan(abs(t) / sqrt(df)) AS a, least(pi() / 2, atan(abs(t) / sqrt(df)) + 40 / sqrt(df)) AS b,
         least(pi() / 2, 40 / sqrt(df)) AS c
  FROM tested
)
SELECT scope, n1 AS n_in, n2 AS n_out, {_even('s1', 'n1', unit_digits, places)} AS mean_in,
       {_even('s2', 'n2', unit_digits, places)} AS mean_out,
       CASE WHEN n1 > 1 AND n2 > 1 THEN round(({_integral('a', 'b')}) / ({_integral('0.0', 'c')}), 4) ELSE 1.0 END AS p
FROM angled
"""


ORACLES["welch_month_flag"] = _welch("month(date) IN (1, 2, 3, 4, 9, 10, 11, 12)", "cnt", 0, 2)
ORACLES["welch_parity"] = _welch("month(date) % 2 = 0", "cents", 2, 0)

# --- deduplication

LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax, l_returnflag, l_linestatus, l_shipdate"""


def _survivor(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in (
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ))
    return f"""
SELECT * EXCLUDE (place) FROM (
  SELECT {LINE_COLUMNS}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS place FROM lineitem
) WHERE place = 1
"""


ORACLES["dedup_keep_first"] = _survivor("ASC")
ORACLES["dedup_keep_last"] = _survivor("DESC")
ORACLES["distinct_rows"] = "SELECT DISTINCT * FROM lineitem"
ORACLES["first_tx_per_account"] = """
SELECT o_custkey AS client_id, min(o_orderkey) AS branch_id, arg_min(o_totalprice, o_orderkey) AS balance FROM orders GROUP BY 1
"""
ORACLES["last_branch_per_employee"] = """
SELECT l_suppkey AS employee_id, max(l_partkey) AS employee_branch_id FROM (
  SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC) AS place FROM lineitem
) WHERE place = 1 GROUP BY 1
"""

# --- joins

ORACLES["account_dimension"] = f"""
WITH {CLIENTS} SELECT client_id AS account_id, branch_ix, band_ix FROM banded LEFT JOIN branch_ix USING (branch_id)
"""
ORACLES["client_dimension"] = f"""
WITH {CLIENTS}
SELECT client_id, band_ix, CAST(year(joined) AS INTEGER) AS joined_year, branch_id, branch_ix, c_acctbal + 0.0 AS balance
FROM banded LEFT JOIN branch_ix USING (branch_id)
"""
ORACLES["spread_lookup_hot"] = """
SELECT event_id, CASE WHEN value >= 1 THEN e.event_type END AS event_type, CASE WHEN value >= 1 THEN first_id END AS first_id
FROM events e JOIN (SELECT event_type, min(event_id) AS first_id FROM events GROUP BY 1) k ON e.event_type = k.event_type
"""
ORACLES["null_matching_join"] = f"""
WITH {CLIENTS} SELECT branch_id, count(*) AS accounts, {_money('c_acctbal')} AS balance FROM clients GROUP BY 1
"""

# --- dimensions

ORACLES["headcount"] = """
SELECT CAST(n_nationkey AS BIGINT) AS branch_id, replace(n_name, 'NATION_', '') AS short_name, count(s_suppkey) AS employees
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2
"""
ORACLES["branch_dimension"] = """
SELECT CAST(rank() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS branch_ix, CAST(n_nationkey AS BIGINT) AS branch_id,
       replace(n_name, 'NATION_', '') AS short_name, r_name AS state,
       CASE WHEN n_nationkey = 0 THEN 'Digital' ELSE 'Física' END AS branch_kind,
       (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS employees
FROM nation JOIN region ON n_regionkey = r_regionkey
"""
ORACLES["grand_totals"] = f"""
SELECT (SELECT count(*) FROM customer) AS clients, (SELECT count(*) FROM customer) AS accounts,
       (SELECT count(*) FROM supplier) AS employees, (SELECT count(*) FROM nation) AS branches,
       (SELECT {_money('c_acctbal')} FROM customer) AS balance
"""
ORACLES["dense_index"] = """
SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) - 1 AS INTEGER) AS name_ix FROM (SELECT DISTINCT p_name FROM part)
"""
ORACLES["dense_index_ranges"] = """
SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS name_ix FROM customer
"""
ORACLES["frequency_index"] = """
SELECT p_brand, count(*) AS cnt, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS INTEGER) AS brand_ix
FROM part GROUP BY 1
"""

# --- typing, calendar, labels

ORACLES["calendar_parts"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday,
       CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       strftime(o_orderdate, '%Y-%m-%d') AS iso, o_orderdate IS NOT NULL AS dated,
       month(o_orderdate) NOT BETWEEN 5 AND 8 AS in_months, month(o_orderdate) % 2 = 0 AS even_month
FROM orders
"""


def _full_years(ref_year: int, ref_day: int) -> str:
    before = f"{ref_day} < month(o_orderdate) * 100 + day(o_orderdate)"
    return f"CAST({ref_year} - year(o_orderdate) - CASE WHEN {before} THEN 1 ELSE 0 END AS INTEGER)"


ORACLES["completed_ages"] = f"""
SELECT o_orderkey, {_full_years(2023, 228)} AS age_feb, {_full_years(2024, 229)} AS age_leap,
       round(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') / 365.25, 1) AS age_decimal
FROM orders
"""

ORACLES["typed_numbers"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' THEN o_totalprice END AS money,
       CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' THEN o_totalprice END AS rate,
       CAST(left(o_orderpriority, 1) AS INTEGER) AS whole, o_orderstatus <> 'P' AND o_orderpriority = '5-LOW' AS is_missing
FROM orders
"""
ORACLES["typed_timestamps"] = "SELECT o_orderkey, CASE WHEN day(o_orderdate) < 31 THEN o_orderdate END AS at FROM orders"
ORACLES["status_codes"] = f"""
WITH {PROPOSALS}
SELECT status, CASE status WHEN 'Aprovado' THEN 1 WHEN 'Validação' THEN 2 WHEN 'Em análise' THEN 3 ELSE 0 END AS status_ix,
       count(*) AS rows
FROM proposals GROUP BY 1
"""
ORACLES["text_labels"] = """
SELECT n_nationkey, n_name AS short_name, CASE WHEN r_regionkey < 4 THEN CAST(r_regionkey AS INTEGER) END AS state_ix,
       CASE WHEN r_name <> 'ASIA' THEN r_name || ' ' || n_name END AS full_name, ' ' || n_name AS tail, n_name AS tail_trimmed
FROM nation JOIN region ON n_regionkey = r_regionkey
"""
ORACLES["month_numbers"] = """
SELECT lower(strftime(o_orderdate, '%b')) AS name,
       CAST(CASE WHEN month(o_orderdate) IN (1, 3, 6, 7, 11) THEN month(o_orderdate) END AS INTEGER) AS number, count(*) AS rows
FROM orders GROUP BY ALL
"""
ORACLES["rate_bins"] = """
WITH rated AS (SELECT (l_discount * 0.25) * 100 + 0.0 AS pct FROM lineitem)
SELECT pct, CASE WHEN pct >= 0.8 AND pct <= 2.5 THEN CAST(
         (pct > 1.0)::INTEGER + (pct > 1.2)::INTEGER + (pct > 1.4)::INTEGER + (pct > 1.6)::INTEGER
         + (pct > 1.8)::INTEGER + (pct > 2.0)::INTEGER + (pct > 2.2)::INTEGER AS INTEGER) END AS bin, count(*) AS rows
FROM rated GROUP BY ALL
"""
ORACLES["rounding_rules"] = f"""
WITH cents AS (SELECT o_orderkey, o_custkey, {_cents('o_totalprice')} AS c FROM orders)
SELECT o_orderkey, {_mean('c', '2', 2, 2)} AS half_up, {_even('c', '2', 2, 2)} AS half_even,
       1.0::DOUBLE / CAST(nullif(o_custkey % 3, 0) AS DOUBLE) AS guarded
FROM cents
"""

# --- checks

ORACLES["dq_unique_key"] = """
SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem
"""
ORACLES["dq_orphans"] = """
SELECT count(*) AS orphans FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 500)
"""
ORACLES["dq_nulls"] = f"""
WITH {CLIENTS}
SELECT count(*) AS rows, count(*) FILTER (WHERE birth IS NULL) AS birth_date_nulls,
       count(*) FILTER (WHERE branch_id IS NULL) AS branch_id_nulls, count(*) FILTER (WHERE joined IS NULL) AS joined_at_nulls
FROM clients
"""
ORACLES["dq_balances"] = """
SELECT count(*) FILTER (WHERE c_acctbal < 0) AS negative, count(*) FILTER (WHERE c_acctbal >= 9000) AS missing FROM customer
"""
ORACLES["dq_totals_match"] = "SELECT count(*) AS source_rows, count(*) AS fact_rows, true AS passed FROM orders"
ORACLES["dq_constraints"] = """
SELECT 'nation' AS "table", 'not_null' AS "constraint", 'n_nationkey' AS "column", CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'nation', 'unique', 'n_nationkey', count(*) - count(DISTINCT n_nationkey) FROM nation
UNION ALL SELECT 'customer', 'not_null', 'c_custkey', count(*) - count(c_custkey) FROM customer
UNION ALL SELECT 'customer', 'not_null', 'c_nationkey', count(*) FROM customer WHERE c_acctbal < 500
UNION ALL SELECT 'customer', 'unique', 'c_custkey', count(*) - count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'orders', 'not_null', 'o_orderkey', count(*) - count(o_orderkey) FROM orders
UNION ALL SELECT 'orders', 'not_null', 'o_custkey', count(*) - count(o_custkey) FROM orders
UNION ALL SELECT 'orders', 'unique', 'o_orderkey', count(*) - count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'lineitem', 'not_null', 'l_orderkey', count(*) - count(l_orderkey) FROM lineitem
UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey', count(*) - count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'lineitem', 'max_length', 'l_returnflag', count(*) FILTER (WHERE length(l_returnflag) > 1) FROM lineitem
UNION ALL SELECT 'documents', 'max_length', 'text', count(*) FILTER (WHERE length(text) > 1000) FROM documents
UNION ALL SELECT 'documents', 'unique', 'doc_id', count(*) - count(DISTINCT doc_id) FROM documents
UNION ALL SELECT 'customer', 'references', 'c_nationkey', count(*) FROM customer
  WHERE c_acctbal >= 500 AND c_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'orders', 'references', 'o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem', 'references', 'l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem', 'references', 'l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'documents', 'references', 'doc_id', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
"""
ORACLES["row_counts"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}"
    for t in ("nation", "customer", "supplier", "orders", "lineitem", "events", "pages")
)

# --- raw files, layers, job

ORACLES["bronze_transactions"] = """
WITH n AS (SELECT count(*) + count(*) FILTER (WHERE day(o_orderdate) = 1) AS n FROM orders)
SELECT n AS rows, n AS last_positions, CAST(0 AS BIGINT) AS first_position, CAST(0 AS BIGINT) AS ordinal_gap,
       CAST(0 AS BIGINT) AS rejected FROM n
"""

TYPE_NAMES = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Compra Crédito' WHEN '2-HIGH' THEN 'Pix' WHEN '3-MEDIUM' THEN 'Boleto Pago'
  WHEN '4-NOT SPECIFIED' THEN 'Depósito' ELSE 'Saque Eletrônico' END"""

ORACLES["silver_transactions"] = f"""
SELECT o_orderkey AS tx_id, CAST(o_custkey AS VARCHAR) AS account_id, o_orderdate AS tx_at, {TYPE_NAMES} AS tx_type,
       o_totalprice AS amount, o_totalprice AS amount_abs, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday
FROM orders WHERE day(o_orderdate) < 31
"""
ORACLES["silver_branches"] = """
SELECT CAST(n_nationkey AS BIGINT) AS branch_id, 'Agência ' || replace(n_name, 'NATION_', '') AS branch_name,
       replace(n_name, 'NATION_', '') AS short_name, 'Rua, ' || n_nationkey || ' - Sé' AS address, n_name AS city,
       CASE n_regionkey WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'RS' WHEN 3 THEN 'SC' ELSE 'MG' END AS state,
       DATE '2010-01-01' AS opened_on, CASE WHEN n_nationkey = 0 THEN 'Digital' ELSE 'Física' END AS branch_kind
FROM nation
"""
ORACLES["silver_clients"] = f"""
WITH {CLIENTS}
SELECT client_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
       split_part(c_name, '#', 2) || '@example.org' AS email, 'PF' AS client_kind, birth AS birth_date, '000' AS tax_id,
       'Rua A / SP' AS address, '01310-916' AS postcode, joined + INTERVAL 10 HOUR AS joined_at, age_years,
       CASE band_ix WHEN 0 THEN 'Jovem (<25)' WHEN 1 THEN 'Adulto (25-59)' WHEN 2 THEN 'Idoso (60+)' ELSE 'Indefinida' END AS age_band
FROM banded
"""
ORACLES["silver_accounts"] = f"""
WITH {CLIENTS}
SELECT CAST(client_id AS VARCHAR) AS account_id, client_id, branch_id, 'PF' AS account_kind, DATE '2015-05-05' AS opened_on,
       c_acctbal + 0.0 AS balance, c_acctbal + 0.0 AS available_balance
FROM clients
"""
ORACLES["silver_proposals"] = f"""
WITH {PROPOSALS}
SELECT o_custkey AS client_id, employee_id, CASE WHEN day(l_shipdate) < 31 AND day(l_shipdate) % 6 <> 5 THEN l_shipdate END AS submitted_at,
       rate + 0.0 AS monthly_rate, l_extendedprice AS proposed_amount, l_extendedprice AS financed_amount,
       l_quantity AS down_payment, CAST(1 AS DOUBLE) AS installment_amount, installments, 0 AS grace_months, status,
       CAST(CASE WHEN day(l_shipdate) < 31 AND day(l_shipdate) % 6 <> 5 THEN year(l_shipdate) ELSE 0 END AS INTEGER) AS year
FROM proposals LEFT JOIN orders ON l_orderkey = o_orderkey
"""
ORACLES["silver_employees"] = """
SELECT s_suppkey AS employee_id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
       'x@example.org' AS email, '000' AS tax_id, DATE '1980-02-29' AS birth_date, 'Rua B / RJ' AS address,
       '20000-000' AS postcode, CAST(NULL AS VARCHAR) AS role
FROM supplier
"""
ORACLES["silver_employee_branch"] = """
SELECT DISTINCT s_suppkey AS employee_id, CAST(s_nationkey AS BIGINT) AS branch_id FROM supplier
"""
ORACLES["silver_price_index"] = f"""
WITH {INDEX}
SELECT CAST(year(month_start) AS INTEGER) AS year, CAST(month(month_start) AS INTEGER) AS month,
       ['JAN', 'FEV', 'MAR', 'ABR', 'MAI', 'JUN', 'JUL', 'AGO', 'SET', 'OUT', 'NOV', 'DEZ'][month(month_start)] AS month_name,
       CAST(100 AS DOUBLE) AS index_level, CAST((micro + 50) // 100 AS DOUBLE) / 100.0 AS month_pct,
       CAST(0 AS DOUBLE) AS pct_3m, CAST(0 AS DOUBLE) AS pct_6m, CAST(0 AS DOUBLE) AS pct_ytd,
       CAST((micro * 12 + 50) // 100 AS DOUBLE) / 100.0 AS pct_12m
FROM monthly_index
"""
ORACLES["typed_load"] = """
SELECT o_orderkey AS tx_id, CAST(o_custkey AS VARCHAR) AS account_id, o_orderdate AS tx_at, o_orderpriority AS tx_type,
       o_totalprice AS amount FROM orders
"""
ORACLES["job_tx_evolution"] = f"""
WITH {TX}
SELECT year AS ano, month AS mes, branch_ix AS ai, band_ix AS fidx, count(*) AS cnt, {_money('o_totalprice')} AS vol
FROM tx WHERE day < 31 GROUP BY ALL
"""
ORACLES["job_report"] = f"""
WITH {TX}, kept AS (SELECT * FROM tx WHERE day < 31),
{PLACED.replace(CLIENTS + ',', '')},
dated AS (SELECT * REPLACE (CASE WHEN day = 31 OR day % 6 = 5 THEN 0 ELSE year END AS year) FROM placed WHERE branch_ix IS NOT NULL)
SELECT 'txEvo' AS section, count(*) AS rows FROM (SELECT DISTINCT year, month, branch_ix, band_ix FROM kept)
UNION ALL SELECT 'txType', count(*) FROM (SELECT DISTINCT year, branch_ix, band_ix, tx_type FROM kept WHERE branch_ix IS NOT NULL)
UNION ALL SELECT 'saqueFact', count(*) FROM (
  SELECT DISTINCT year, month, branch_ix, band_ix FROM kept WHERE branch_ix IS NOT NULL AND tx_type = '5-LOW')
UNION ALL SELECT 'cliFact', count(*) FROM (
  SELECT DISTINCT branch_ix, band_ix, year(joined) FROM banded JOIN branch_ix USING (branch_id)
  JOIN nation ON n_nationkey = branch_id WHERE n_regionkey < 4)
UNION ALL SELECT 'propFact', count(*) FROM (SELECT DISTINCT year, branch_ix, band_ix, status_ix FROM dated)
UNION ALL SELECT 'propRaw', count(*) FROM (SELECT DISTINCT year, branch_ix, band_ix, rate_bin, installments FROM dated)
UNION ALL SELECT 'ipcaSer', CAST(0 AS BIGINT)
"""

ORACLES["job_fact_totals"] = f"""
WITH {TX}, kept AS (SELECT * FROM tx WHERE day < 31),
{PLACED.replace(CLIENTS + ',', '')},
dated AS (SELECT * REPLACE (CASE WHEN day = 31 OR day % 6 = 5 THEN 0 ELSE year END AS year) FROM placed WHERE branch_ix IS NOT NULL),
placed_clients AS (
  SELECT branch_ix, band_ix, year(joined) AS joined_year, c_acctbal FROM banded JOIN branch_ix USING (branch_id)
  JOIN nation ON n_nationkey = branch_id WHERE n_regionkey < 4
)
SELECT 'fact_tx_evolucao' AS fact, count(DISTINCT (year, month, branch_ix, band_ix)) AS groups, count(*) AS cnt, {_money('o_totalprice')} AS amount
FROM kept
UNION ALL SELECT 'fact_tx_tipo', count(DISTINCT (year, branch_ix, band_ix, tx_type)), count(*), {_money('o_totalprice')}
FROM kept WHERE branch_ix IS NOT NULL
UNION ALL SELECT 'fact_saques', count(DISTINCT (year, month, branch_ix, band_ix)), NULL, {_money('o_totalprice')}
FROM kept WHERE branch_ix IS NOT NULL AND tx_type = '5-LOW'
UNION ALL SELECT 'fact_clientes', count(DISTINCT (branch_ix, band_ix, joined_year)), count(*), {_money('c_acctbal')} FROM placed_clients
UNION ALL SELECT 'fact_propostas', count(DISTINCT (year, branch_ix, band_ix, status_ix)), count(*), {_money('l_extendedprice')} FROM dated
"""

NOTE = """CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || ',' || chr(10) || '"' || o_orderkey || '"' || chr(10) || chr(10) || 'end'
  ELSE o_orderpriority END"""
ORACLES["bronze_line_breaks"] = f"""
SELECT o_orderkey AS tx_id, {NOTE} AS tx_type, o_totalprice AS amount FROM orders
"""
ORACLES["bronze_rejects"] = """
SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'too few fields' WHEN o_orderkey % 13 = 0 THEN 'too many fields'
            WHEN o_orderkey % 17 = 0 THEN 'open quote' WHEN o_orderkey % 19 = 0 THEN 'bad key' ELSE 'taken' END AS reason,
       count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders GROUP BY 1
"""
ORACLES["bronze_latin1"] = """
SELECT c_custkey AS employee_id, 'João Ñ ' || c_name AS first_name,
       ['as=utf8', 'as=latin1', 'as=marked'][1 + c_custkey % 3] AS folder
FROM customer
"""
ORACLES["typed_dates"] = f"""
WITH {CLIENTS}
SELECT client_id, birth AS day_first, birth AS year_first, CASE WHEN client_id % 4 <> 0 THEN birth END AS mixed FROM clients
"""
ORACLES["typed_dates_lost"] = f"""
WITH {CLIENTS}
SELECT 'clients' AS "table", 'client_id' AS "column", count(*) FILTER (WHERE client_id % 10 = 0) AS lost FROM clients
UNION ALL SELECT 'clients', 'birth_date', count(*) FILTER (WHERE client_id % 10 <> 0 AND client_id % 4 = 0 AND birth IS NOT NULL) FROM clients
UNION ALL SELECT 'clients', 'joined_at', CAST(0 AS BIGINT)
"""
ORACLES["typed_money_wide"] = """
WITH wide AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS account_id, CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE 1 END
         * CAST(CAST(1000000000000000 + o_orderkey AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS DECIMAL(28,4)) AS balance
  FROM orders
)
SELECT account_id, CAST(balance AS VARCHAR) AS balance, CAST((SELECT sum(balance) FROM wide) AS VARCHAR) AS total FROM wide
"""

_LAKE = f"""
WITH {TX}, kept AS (SELECT * FROM tx WHERE day < 31),
{PLACED.replace(CLIENTS + ',', '')},
dated AS (SELECT * REPLACE (CASE WHEN day = 31 OR day % 6 = 5 THEN 0 ELSE year END AS year) FROM placed WHERE branch_ix IS NOT NULL),
kept_ix AS (
  SELECT tx_type, name, CAST(row_number() OVER (ORDER BY n DESC, name) - 1 AS INTEGER) AS type_ix
  FROM (SELECT tx_type, {TYPE_NAMES.replace('o_orderpriority', 'tx_type')} AS name, count(*) AS n FROM kept GROUP BY 1)
),
state_names AS (SELECT * FROM (VALUES (0, 'SP'), (1, 'RJ'), (2, 'RS'), (3, 'SC'), (4, 'MG')) AS s(region, uf)),
placed_clients AS (
  SELECT branch_ix, band_ix, CAST(n_regionkey AS INTEGER) AS state_ix, CAST(year(joined) AS INTEGER) AS joined_year, c_acctbal
  FROM banded JOIN branch_ix USING (branch_id) JOIN nation ON n_nationkey = branch_id WHERE n_regionkey < 4
)"""


def _rowed(section: str, source: str, keys: list[str], fields: dict[str, str], kind: str = "number") -> str:
    """Long form of a grouped section: one row for each group and field."""
    row = "concat_ws('|', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys) + ")"
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {row} AS row, '{name}' AS field, CAST({value} AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS text "
        f"FROM {source} GROUP BY {', '.join(keys)}" for name, value in fields.items()
    )


def _whole(column: str) -> str:
    return _even(f"sum({_cents(column)})", "1", 2, 0)


def _plain(section: str, row: str, field: str, number: str, text: str, source: str) -> str:
    return f"""SELECT '{section}' AS section, {row} AS row, '{field}' AS field, CAST({number} AS DOUBLE) AS number, CAST({text} AS VARCHAR) AS text {source}"""


def _dims() -> str:
    def item(part: str, i: str, nome: str, source: str, uf: str = "NULL", tipo: str = "NULL", valor: str = "NULL") -> str:
        row = f"concat_ws('|', '{part}', coalesce(CAST({i} AS VARCHAR), '-'), {nome})"
        return " UNION ALL ".join([
            _plain("dims", row, "uf", "NULL", uf, source), _plain("dims", row, "tipo", "NULL", tipo, source), _plain("dims", row, "valor", valor, "NULL", source),
        ])

    listed = lambda part, values: item(
        part, "i", "nome", "FROM (VALUES " + ", ".join(f"({i}, '{v}')" for i, v in enumerate(values)) + ") AS v(i, nome)"
    )
    totals = {
        "clientes": "(SELECT count(*) FROM customer)", "contas": "(SELECT count(*) FROM customer)", "colaboradores": "(SELECT count(*) FROM supplier)",
        "agencias": "(SELECT count(*) FROM nation)", "saldoTotal": f"(SELECT {_whole('c_acctbal')} FROM customer)",
    }
    return " UNION ALL ".join([
        item(
            "agencias", "branch_ix", "replace(n_name, 'NATION_', '')", "FROM nation JOIN branch_ix ON branch_id = n_nationkey JOIN state_names ON region = n_regionkey",
            "uf", "CASE WHEN n_nationkey = 0 THEN 'Digital' ELSE 'Física' END", "(SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey)",
        ),
        item("tipos", "type_ix", "name", "FROM kept_ix"),
        listed("faixas", ["Jovem (<25)", "Adulto (25-59)", "Idoso (60+)"]), listed("estados", ["SP", "RJ", "RS", "SC", "PE"]),
        listed("jurosBins", ["0,8-1,0", "1,0-1,2", "1,2-1,4", "1,4-1,6", "1,6-1,8", "1,8-2,0", "2,0-2,2", "2,2-2,5"]),
        *[item("totals", "NULL", f"'{n}'", "FROM (SELECT 1)", valor=v) for n, v in totals.items()],
    ])


# the job's daily series: dated transactions, its own threshold and years
_JOB_DAILY = (
    DAILY.replace("FROM orders GROUP BY 1", "FROM orders WHERE day(o_orderdate) < 31 GROUP BY 1")
    .replace("SELECT sum(cnt) * 3 // (count(*) * 2) AS threshold FROM daily", "SELECT 200 AS threshold").replace("(1998, 1999, 2000)", "(2020, 2021, 2022)")
)


def _tempo() -> str:
    """Long form of the section's rows, each from the query of its own analysis."""
    def part(name: str, query: str, i: str, values: dict[str, str]) -> str:
        fields = {"c": "NULL", "v": "NULL", "p": "NULL"} | values
        row = f"concat_ws('|', '{name}', scope, coalesce(CAST({i} AS VARCHAR), '-'))"
        numbers = [_plain("tempo", row, f, v, "NULL", f"FROM ({query.replace(DAILY, _JOB_DAILY)})") for f, v in fields.items()]
        return " UNION ALL ".join([*numbers, _plain("tempo", row, "at", "NULL", "NULL", f"FROM ({query.replace(DAILY, _JOB_DAILY)})")])

    summary = f"WITH {_JOB_DAILY} SELECT '-' AS scope, "
    has = f"WITH {_JOB_DAILY} SELECT s.scope, CAST(count(d.scope) > 0 AS INTEGER) AS has FROM (VALUES ('all'), ('2020'), ('2021'), ('2022')) AS s(scope) LEFT JOIN (SELECT DISTINCT scope FROM scoped) d USING (scope) GROUP BY 1"
    burst = f"WITH {_JOB_DAILY} SELECT '-' AS scope, row_number() OVER (ORDER BY date) - 1 AS i, CAST(date AS VARCHAR) AS stamp FROM daily WHERE cnt > 200"
    row = "concat_ws('|', 'dumpList', scope, i)"
    return " UNION ALL ".join([
        part("tri", ORACLES["seasonality_quarter"], "quarter", {"c": "mean_cnt", "v": "mean_vol"}),
        part("wd", ORACLES["seasonality_weekday"], "weekday", {"c": "mean_cnt", "v": "mean_vol"}),
        part("rmonths", ORACLES["welch_month_flag"], "NULL", {"c": "mean_in", "v": "mean_out", "p": "p"}),
        part("parimpar", ORACLES["welch_parity"], "NULL", {"c": "mean_in", "v": "mean_out", "p": "p"}),
        part("byYear", has, "NULL", {"c": "has"}),
        part("dumpDays", summary + "count(*) FILTER (WHERE cnt > 200) AS n FROM daily", "NULL", {"c": "n"}),
        part("txClean", summary + "coalesce(sum(cnt) FILTER (WHERE cnt <= 200), 0) AS n FROM daily", "NULL", {"c": "n"}),
        part("txTotal", summary + "coalesce(sum(cnt), 0) AS n FROM daily", "NULL", {"c": "n"}),
        *[_plain("tempo", row, f, "NULL", "NULL", f"FROM ({burst})") for f in ("c", "v", "p")], _plain("tempo", row, "at", "NULL", "stamp", f"FROM ({burst})"),
    ])


_PLACED_FIELDS = {
    "cnt": "count(*)", "proposed": _whole("l_extendedprice"), "rate_total": "CAST(sum(discount_pct) * 25 AS BIGINT) / 10000.0",
    "installments": "sum(installments)", "financed": _whole("l_extendedprice"), "down": _whole("l_quantity"),
}
ORACLES["job_report_values"] = _LAKE + " UNION ALL ".join(["\n" + _rowed(
    "txEvo", "kept", ["year", "month", "branch_ix", "band_ix"], {"cnt": "count(*)", "vol": _whole("o_totalprice")}),
    _rowed("txType", "(SELECT * FROM kept JOIN kept_ix USING (tx_type) WHERE branch_ix IS NOT NULL)", ["year", "branch_ix", "band_ix", "type_ix"],
           {"cnt": "count(*)", "vol": _whole("o_totalprice")}),
    _rowed("saqueFact", "(SELECT * FROM kept WHERE branch_ix IS NOT NULL AND tx_type = '5-LOW')", ["year", "month", "branch_ix", "band_ix"],
           {"vol": _whole("o_totalprice")}),
    _rowed("cliFact", "placed_clients", ["branch_ix", "band_ix", "state_ix", "joined_year"], {"cnt": "count(*)", "balance": _whole("c_acctbal")}),
    _rowed("propFact", "dated", ["year", "branch_ix", "band_ix", "status_ix"], _PLACED_FIELDS),
    _rowed("propRaw", "dated", ["year", "branch_ix", "band_ix", "rate_bin", "installments"], {"cnt": "count(*)"}),
    _dims(), _tempo(),
])

_BRONZE = """(SELECT count(*) FROM nation) + 2 * (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
  + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM lineitem)
  + (SELECT count(*) + count(*) FILTER (WHERE day(o_orderdate) = 1) FROM orders)
  + (SELECT count(DISTINCT date_trunc('month', l_shipdate)) FROM lineitem)"""
_KEPT = "(SELECT count(*) FROM orders WHERE day(o_orderdate) < 31)"


def _checks() -> str:
    # (name, measures, total of the whole lake, passes on the half one, its total)
    facts = f"(SELECT sum(groups) FROM ({ORACLES['job_fact_totals']}))"
    sections = " + ".join([
        f"(SELECT sum(rows) FROM ({ORACLES['job_report']}))", f"(SELECT count(*) // 3 FROM ({ORACLES['job_report_values']}) WHERE section = 'dims')",
        f"(SELECT count(*) // 4 FROM ({ORACLES['job_report_values']}) WHERE section = 'tempo')",
    ])
    rows = [
        ("bronze.files", 8, _BRONZE, True, _BRONZE), ("bronze.non_empty", 8, _BRONZE, True, _BRONZE), ("silver.pks", 6, "0", True, "0"),
        ("silver.dates", 1, "0", True, "0"), ("silver.saldos", 2, "(SELECT count(*) FROM customer WHERE c_acctbal < 0)", True, "(SELECT count(*) FROM customer WHERE c_acctbal < 0)"),
        ("gold.facts", 5, facts, False, "0"), ("gold.totals_match", 2, f"2 * {_KEPT}", False, _KEPT), ("gold.json_keys", 9, sections, False, "0"),
    ]
    parts = []
    for name, size, whole, passes, half in rows:
        parts.append(f"SELECT 'whole' AS lake, '{name}' AS name, true AS passed, {size} AS measures, CAST({whole} AS BIGINT) AS total")
        parts.append(f"SELECT 'half', '{name}', {str(passes).lower()}, {size}, CAST({half} AS BIGINT)")
    return " UNION ALL ".join(parts)


ORACLES["job_checks"] = _checks()
ORACLES["typed_load_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {table}"
    for name, table in {
        "branches": "nation", "clients": "customer", "employees": "supplier", "accounts": "customer", "proposals": "lineitem",
        "transactions": "orders", "index_series": "(SELECT DISTINCT date_trunc('month', l_shipdate) FROM lineitem)",
    }.items()
)
