"""Folders of any store that Spark reads: names, markers, removal. Only names pass through the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none where there is no folder."""
    system, where = _located(spark, path)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, which is there wholly or not at all."""
    system, where = _located(spark, path)
    system.mkdirs(where.getParent())
    system.createNewFile(where)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _located(spark, path)
    system.delete(where, True)
