"""Bronze, silver and gold as Parquet folders, one per table.

A job writes each layer into a folder of its own run below the lake root. An empty marker file, made when all tables of the
layer are complete, says that the run is read from then on; a run that fails never shows and is removed. Tables written
outside of a run lie directly below their layer. What a write observes, or a scan of a few columns after it finds, is kept
beside the tables.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from . import files
from .delimited import CORRUPT, REASON, with_row_index

STAGING = "staging"   # of the typed bulk load
LAYERS = ("bronze", "silver", "gold", STAGING)
#: An item of a list is frequent with more than one in so many rows.
FREQUENT = 4096
#: Of the tables of all layers.
COMPRESSION = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
MEASURES = "layer string, table string, measure string, value bigint"


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    # schemas of tables written through this object, which spares reading file footers again
    schemas: dict[str, StructType] = field(default_factory=dict, compare=False, repr=False)
    # run of each layer that this object keeps to; others are looked up at each use
    runs: dict[str, str] = field(default_factory=dict, compare=False, repr=False)
    # what writes through this object observed, by layer and table
    observed: dict[tuple[str, str], dict[str, int]] = field(default_factory=dict, compare=False, repr=False)

    @property
    def _base(self) -> str:
        return self.root.rstrip("/")

    def _published(self, layer: str) -> str:
        """The newest complete run of a layer; run names sort by time."""
        return max(files.names(self.spark, f"{self._base}/_published/{layer}"), default="")

    def run_of(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return self.runs[layer] if layer in self.runs else self._published(layer)

    def pinned(self) -> Lake:
        """The same lake that keeps to the runs that are complete now."""
        return replace(self, runs={layer: self._published(layer) for layer in LAYERS}, observed={})

    @contextmanager
    def run(self, layer: str) -> Iterator[None]:
        """Writes to ``layer`` go into a new run, which replaces the one before when all is well, and else is removed."""
        before, own = self.run_of(layer), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.runs[layer] = own
        for key in [key for key in self.observed if key[0] in (layer, *({"report"} if layer == "gold" else ()))]:
            del self.observed[key]
        try:
            yield
            self._keep_measures(layer)
        except BaseException:
            self.runs[layer] = before
            files.remove(self.spark, f"{self._base}/{layer}/{own}")
            raise
        files.mark(self.spark, f"{self._base}/_published/{layer}/{own}")
        if before:
            files.remove(self.spark, f"{self._base}/_published/{layer}/{before}")
            files.remove(self.spark, f"{self._base}/{layer}/{before}")

    def path(self, layer: str, table: str) -> str:
        run = self.run_of(layer)
        return f"{self._base}/{layer}/{run}/{table}" if run else f"{self._base}/{layer}/{table}"

    @property
    def report_path(self) -> str:
        return self.path("gold", "report")

    def write(
        self, df: DataFrame, layer: str, table: str, measures: Mapping[str, Column] | None = None,
        scanned: Mapping[str, Column] | None = None,
    ) -> None:
        """Replaces a table; ``measures`` are aggregates that the same write observes, ``scanned`` those that compute much of a
        row: Spark observes without generated code, so a scan of their columns after the write costs less."""
        path = self.path(layer, table)
        observation = Observation() if measures else None
        rows = df.observe(observation, *[m.alias(n) for n, m in measures.items()]) if measures else df
        rows.write.mode("overwrite").options(**COMPRESSION).parquet(path)
        self.schemas[path] = df.schema
        found = dict(observation.get) if observation else {}
        if scanned:
            found |= self.read(layer, table).agg(*[m.alias(n) for n, m in scanned.items()]).first().asDict()
        if found:
            self.record(layer, table, found)

    def record(self, layer: str, table: str, values: Mapping[str, object]) -> None:
        """Keeps numbers as they are; a list of frequent items (item, count) as one number for each of the frequent ones."""
        kept: dict[str, int] = {}
        rows = values.get("rows", 0)
        for name, value in values.items():
            if isinstance(value, list):
                kept |= {f"{name}: {i['item']}": i["count"] for i in value if i["item"] is not None and i["count"] * FREQUENT > rows}
            else:
                kept[name] = value
        self.observed[layer, table] = kept

    def _keep_measures(self, layer: str) -> None:
        rows = [
            (kept, table, name, value) for (kept, table), values in self.observed.items()
            if kept == layer or layer == "gold" and kept == "report" for name, value in values.items()
        ]
        self.spark.createDataFrame(rows, MEASURES).coalesce(1).write.mode("overwrite").parquet(self.path(layer, "measures"))

    def measures(self) -> DataFrame:
        """``layer, table, measure, value`` of all layers that were written in runs."""
        result = self.spark.createDataFrame([], MEASURES)
        for layer in LAYERS:
            run = self.run_of(layer)
            if run:
                result = result.unionByName(self.spark.read.schema(MEASURES).parquet(self.path(layer, "measures")))
        return result

    def measured(self, layer: str) -> dict[str, dict[str, int]]:
        """The measures of a layer by table; empty for one that was not written in a run."""
        if any(key[0] == layer for key in self.observed):
            return {table: values for (kept, table), values in self.observed.items() if kept == layer}
        if not self.run_of(layer):
            return {}
        found: dict[str, dict[str, int]] = {}
        # a few rows for each table
        for row in self.spark.read.schema(MEASURES).parquet(self.path(layer, "measures")).filter(F.col("layer") == layer).collect():
            found.setdefault(row.table, {})[row.measure] = row.value
        return found

    def read(self, layer: str, table: str) -> DataFrame:
        path = self.path(layer, table)
        reader = self.spark.read.schema(self.schemas[path]) if path in self.schemas else self.spark.read
        return reader.parquet(path)

    def exists(self, layer: str, table: str) -> bool:
        try:
            self.read(layer, table)
        except AnalysisException:
            return False
        return True

    def bronze(self, table: str, row_index: bool = False) -> DataFrame:
        """Accepted raw rows with lineage columns, optionally with their ordinal in the source file."""
        rows = self.read("bronze", table).filter(~F.col("_rejected")).drop("_rejected", REASON, CORRUPT)
        return with_row_index(rows) if row_index else rows

    def rejects(self, table: str) -> DataFrame:
        return self.read("bronze", table).filter("_rejected").select(CORRUPT, REASON, "_source_file", "_ingestion_ts")

    def create_views(self, layer: str, tables: Iterable[str]) -> None:
        """Temporary views named after the tables, for ad-hoc SQL."""
        for table in tables:
            self.read(layer, table).createOrReplaceTempView(table)

    def silver(self, table: str) -> DataFrame:
        return self.read("silver", table)

    def gold(self, table: str) -> DataFrame:
        return self.read("gold", table)


def without_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])
