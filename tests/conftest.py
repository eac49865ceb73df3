import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tallystrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=8)


@pytest.fixture
def rows(spark):
    """Builds a frame from a DDL schema and tuples."""
    return lambda schema, *values: spark.createDataFrame(list(values), schema)
