"""Plan rules that hold for every registered query, and column pruning of some."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not at hand")
QUERIES = {name: build for name, build in entry_point.queries().items() if not name.startswith("job_")}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products_and_no_python(spark, name):
    assert not re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|\w*Python\w*|\w*Pandas\w*|ExternalRDD", plan(spark, name))


@pytest.mark.parametrize("name, columns", [
    ("annual_yoy", "o_totalprice:double,o_orderdate:timestamp_ntz"),
    ("top_accounts", "o_custkey:bigint,o_totalprice:double"),
    ("tenor_rate", "l_quantity:double,l_discount:double"),
    ("daily_series", "o_totalprice:double,o_orderdate:timestamp_ntz"),
    ("dq_unique_key", "l_orderkey:bigint,l_linenumber:int"),
])
def test_scans_read_only_what_is_used(spark, name, columns):
    assert re.findall(r"ReadSchema: struct<(.*?)>", plan(spark, name)) == [columns]


@pytest.mark.parametrize("name, exchanges", [("annual_yoy", 1), ("top_accounts", 1), ("dedup_keep_first", 1), ("daily_series", 1)])
def test_rows_are_shuffled_once(spark, name, exchanges):
    assert plan(spark, name).count("Exchange hashpartitioning") == exchanges


def test_rankings_keep_only_the_top(spark):
    assert all("TakeOrderedAndProject" in plan(spark, n) for n in ("top_accounts", "top_employees", "client_balance_top", "url_tail_top"))


def test_totals_of_shares_read_no_column(spark):
    assert "ReadSchema: struct<>" in plan(spark, "tx_by_type_share")
