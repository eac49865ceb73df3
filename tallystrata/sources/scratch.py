"""Lineage cuts: a table written to the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from . import files

_local_roots: dict[str, str] = {}
#: Folders that a running job lends, by application.
_lent: dict[str, list[str]] = {}


@contextmanager
def lent(spark: SparkSession, folder: str) -> Iterator[None]:
    """Uses ``folder`` where the session names none, and removes it afterwards."""
    if spark.conf.get("spark.checkpoint.dir", None) is not None:
        yield
        return
    own = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    stack = _lent.setdefault(spark.sparkContext.applicationId, [])
    stack.append(own)
    try:
        yield
    finally:
        stack.remove(own)
        files.remove(spark, own)


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        context = spark.sparkContext
        if _lent.get(context.applicationId):
            return _lent[context.applicationId][-1]
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_roots.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="tallystrata-")
        _local_roots[context.applicationId] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/tallystrata/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning = threading.Lock()
#: For each application how many writes are on their way, and what the setting was before them.
_writes: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the executions inside go when these end, not when the driver happens to collect its garbage.

    Nothing reads them again: what an execution leaves is in its table. The setting is as before afterwards.
    """
    key = spark.sparkContext.applicationId
    with _cleaning:
        writes, before = _writes.get(key, (0, None))
        if not writes:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _writes[key] = writes + 1, before
    try:
        yield
    finally:
        with _cleaning:
            writes, before = _writes.pop(key)
            if writes > 1:
                _writes[key] = writes - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str = "cut") -> DataFrame:
    """The same rows read back from Parquet, so later passes neither recompute nor change them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_let_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
