"""Registered training-data queries against their SQL, and the pipeline's stages against what they promise."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import compare
import corpus_pipeline
from tallystrata.llm import exact
from tallystrata.llm.oracles import ORACLES
from tallystrata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not at hand")


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare.difference(QUERIES[name](spark, SF), compare.connection(SF), ORACLES[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns, name
        before, after = {r.doc_id for r in kept.select("doc_id").collect()}, [r.doc_id for r in out.select("doc_id").collect()]
        assert len(after) == len(set(after)) and set(after) <= before and len(after) > 0.5 * len(before), name
        kept = spark.createDataFrame(out.collect(), docs.schema)
    mixed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert {r.doc_id for r in mixed} == set(after)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == set(after)


def test_mixed_rows_are_whole(spark):
    """Texts come in the order of training, also with ids that are null or recur."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = exact.drop_duplicates(docs).withColumn("doc_id", F.expr("if(doc_id % 7 = 0, null, doc_id)")).cache()
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == [*docs.columns, "block", "position"]
    assert sorted(map(repr, mixed.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    positions = [r.position for r in mixed.collect()]
    assert positions == sorted(positions)
