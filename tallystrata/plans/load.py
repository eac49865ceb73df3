"""Staged bulk load: all tables in their declared types, published together or not at all."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import configure
from ..sources.delimited import UTF8, read_typed
from ..sources.layers import STAGING, Lake
from ..sources.tables import BY_NAME, INDEX_SERIES, Table

#: Tables of the load; the bridge of employees and branches has no typed form of its own.
LOADED: tuple[Table, ...] = (
    *[BY_NAME[n] for n in ("branches", "clients", "employees", "accounts", "proposals", "transactions")], INDEX_SERIES,
)


def load(
    spark: SparkSession, raw_root: str, lake_root: str, tables: Sequence[Table] = LOADED, encoding: str = UTF8, parallel: int = 8
) -> Lake:
    """Loads every table into the staging layer. A bad value, a header that does not fit or a missing file raises, and the
    tables that were there before stay. The rows of each table are counted by its own write."""
    lake = Lake(configure(spark), lake_root).pinned()

    def write(table: Table) -> None:
        rows = read_typed(spark, f"{raw_root.rstrip('/')}/{table.file}", table, encoding)
        lake.write(rows, STAGING, table.name, {"rows": F.count(F.lit(1))})

    with lake.run(STAGING), ThreadPoolExecutor(parallel) as pool:
        for done in [pool.submit(write, table) for table in tables]:
            done.result()
    return lake


def load_counts(lake: Lake) -> DataFrame:
    """``table, rows`` of the last complete load."""
    loaded = lake.measures().filter((F.col("layer") == STAGING) & (F.col("measure") == "rows"))
    return loaded.select("table", F.col("value").alias("rows"))
