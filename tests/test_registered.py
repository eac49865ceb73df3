"""Every registered query against its SQL, on the driver's smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
import compare
from workload.queries import registered

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not at hand")
QUERIES, ORACLES = registered(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES) and set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
