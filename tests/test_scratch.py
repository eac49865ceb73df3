import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from tallystrata.sources.scratch import scratch_path, scratch_root, shuffles_let_go, stored


def session(configured, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: configured),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_configured_folder_is_used():
    assert scratch_root(session("hdfs://shared/cp/", "yarn")) == "hdfs://shared/cp"
    first, second = (scratch_path(session("hdfs://shared/cp", "yarn"), "raw") for _ in range(2))
    assert first.startswith("hdfs://shared/cp/tallystrata/raw-") and first != second


def test_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session(None, "spark://host:7077"))


def test_local_default_is_kept():
    assert scratch_root(session(None, "local[8]")) == scratch_root(session(None, "local[8]"))


def test_stored_rows_are_cut_from_their_source(spark, rows):
    df = rows("a int, b string", (1, "x"), (2, None)).filter("a > 0")
    cut = stored(df)
    assert sorted(map(tuple, cut.collect())) == [(1, "x"), (2, None)] and cut.dtypes == df.dtypes
    plan = cut._jdf.queryExecution().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan


def test_shuffle_files_go_with_the_write(spark, rows):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with shuffles_let_go(spark):
        with shuffles_let_go(spark):
            assert spark.conf.get(name) == "true"
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before

    folders = {Path(str(x)) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()}
    files = lambda: {x for folder in folders for x in folder.rglob("shuffle_*")}
    kept = files()
    grouped = stored(rows("a int", *[(i,) for i in range(50)]).groupBy("a").count())
    began = time.time()
    while files() - kept and time.time() < began + 10:  # they go a little later
        time.sleep(0.2)
    assert not files() - kept
    assert len(grouped.collect()) == 50
