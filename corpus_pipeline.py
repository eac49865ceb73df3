"""From raw documents to a mixed training set: five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystrata.llm import contamination, exact, language, mixing, near
from tallystrata.sources.scratch import stored

#: How far from a guess among the languages (0) to certainty (1) a prediction must be.
LEAST_CERTAINTY = 1 / 15
#: Bytes of rows that travel to Python at once; rows alone (10,000) are no bound where texts are long.
BATCH = "8m"


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (null and empty ones too) and those whose language cannot be told.

    Rows are judged by themselves, whether ids are null or recur; without a labelled row nothing can be told, and all go.
    """
    _bounded(spark)
    found = language.identify(docs, F.lit(True))
    guess = 1 / max(docs.agg(F.countDistinct("lang")).first()[0], 1)
    least = guess + (1 - guess) * LEAST_CERTAINTY - 1e-9
    return found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= least)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z) the one with the largest id stays; null ids come last, and null texts count as
    empty. Of rows equal in text and id one stays."""
    _bounded(spark)
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 of five-word shingles the smallest id stays; null ids come last.

    Null and empty texts are linked with nothing and stay. Rows with the same id are told apart by their texts; of rows equal
    in both one stays.
    """
    _bounded(spark)
    return near.keep_first(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold 0.8 of a benchmark item's five-word shingles; null and empty texts hold none and stay, rows with
    null or repeated ids are judged by their own texts, and an empty benchmark drops nothing."""
    _bounded(spark)
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training set: whole rows with their block and its position, in ranges of positions and sorted within them.

    The order is found without the texts, which then move twice: to their places and into the ranges. Ids may be null or
    recur, and a null source is one of its own; no row is dropped.
    """
    weights = docs.groupBy("source").agg(F.sqrt(F.count("*")).alias("weight"))
    # Ids may be null or recur; texts differ after the deduplication.
    keys = docs.select(F.col("doc_id").alias("_id"), "source", F.xxhash64("text").alias("_text"))
    order = mixing.mix(keys, weights, id_column="_id").drop("source")
    rows = docs.drop("block", "position")
    placed = rows.join(order, rows["doc_id"].eqNullSafe(order["_id"]) & (F.xxhash64(rows["text"]) == order["_text"])).drop("_id", "_text")
    return placed.repartitionByRange("position").sortWithinPartitions("position")


STAGES = [
    ("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

#: Language identification is learned, which SQL cannot express; tests compare the later stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
