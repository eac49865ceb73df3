"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallystrata.llm import (
    contamination, exact, extraction, language, mixing, near, periodic, pii, pitman_yor, repeats, tokens, urls, whitening,
)

#: Key of the surrogates; a production run passes its own.
SECRET = "registered query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(parts: int, part: int) -> Column:
    """Whether a document belongs to the held-out fold; one without an id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def op1_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", _fold(3, 1))
    return language.identify(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score")


def op2_token_counts(spark, sf_dir):
    return tokens.token_counts(_table(spark, sf_dir, "documents"), tokens.byte_vocabulary(), prefix=b" ")


def op3_url_filters(spark, sf_dir):
    return urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), urls.rules_table(spark))


def op4_lm_scores(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pitman_yor.score(docs, ~_fold(7, 2)).select(
        "doc_id", _fold(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


def op5_near_duplicates(spark, sf_dir):
    return near.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), size=2, percent=80)


def op6_repeats(spark, sf_dir):
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), length=200, keep="none")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_surrogates(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, SECRET)


def op8_contamination(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination.contamination(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op9_exact_duplicates(spark, sf_dir):
    return exact.classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_mixing(spark, sf_dir):
    """Weights by the square root of a source's size, which favours small sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    weights = docs.groupBy("source").agg(F.sqrt(F.count("*")).alias("weight"))
    return mixing.mix(docs, weights)


def op11_whitening(spark, sf_dir):
    """Four components of all usable vectors; see :func:`whitening.whiten` for nulls, ties and repeated rows."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=4, scale=256)


def op12_main_text(spark, sf_dir):
    """The main text of every page; see :func:`extraction.extract` for nulls and empty pages."""
    return extraction.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where one document of ten (by the checksum of its id) repeats a part of its words up to its end.

    Words are written with one space between them there; other texts, and those of null ids, stay as they are.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select(
        "doc_id", "text", F.expr("cast(crc32(cast(cast(doc_id as string) as binary)) div 10 as bigint)").alias("g"),
        F.when(checksum % 10 == 0, F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("words"),
    ).withColumn("n", F.size("words"))
    placed = chosen.withColumn("a", F.expr("if(n > 0, cast(g % n as int), 0)"))
    part = placed.withColumn("p", F.expr("1 + cast((n - a) div (3 + g % 8) as int)"))
    repeated = F.expr(
        "array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), cast((n - a) div p as int) + 1)), 1, n - a)), ' ')"
    )
    return part.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    """Runs of every document; of the longest one start, length, period and exponent, and digests of all runs and of the text left."""
    docs = with_planted_periods(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as back, -r.period as small)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = periodic.periodic_runs(docs).withColumn("longest", longest)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.small")).alias("period"),
        F.expr("1000 * longest.length div -longest.small").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_token_counts, op3_url_filters, op4_lm_scores, op5_near_duplicates, op6_repeats, op7_surrogates,
        op8_contamination, op9_exact_duplicates, op10_mixing, op11_whitening, op12_main_text, op13_periodic_runs,
    )
}
