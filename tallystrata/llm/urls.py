"""URL rules by expanded expressions: hash prefixes are joined, full digests confirm, and the longest rule decides.

Native functions only. Every URL stands for a few expressions, a suffix of its host with a prefix of its path; which
lengths are worth expanding is read off the rules, so neither a host with many labels nor a long path grows a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Hex digits of the digest that are joined on (4 bytes).
PREFIX = 8
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def lowered(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty if null or without ``://``."""
    return F.coalesce(lowered(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """``verdict, rule_host, rule_path`` from tuples."""
    names = ("verdict", "rule_host", "rule_path")
    rows = [F.struct(*[F.lit(x).cast("string").alias(k) for k, x in zip(names, rule)]) for rule in rules]
    table = spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.range(0).select(*[F.lit("").alias(k) for k in names])
    return table.select(*names)


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def expressions(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``addresses`` (host, path) with one row for each host suffix and path prefix that a rule could have."""
    lengths = rules.select(
        F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("letters")
    ).agg(F.collect_set("labels").alias("labels"), F.collect_set("letters").alias("letters"))
    # Columns, as subqueries may not stand inside the functions below.
    sized = addresses.withColumns({
        "_labels": lengths.select("labels").scalar(), "_letters": lengths.select("letters").scalar(), "_parts": F.split("host", r"\."),
    })
    suffix = F.transform(
        F.filter("_labels", lambda n: n <= F.size("_parts")), lambda n: F.array_join(F.slice("_parts", -n, n), ".")
    )
    prefix = F.transform(F.filter("_letters", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    return sized.withColumn("_suffix", F.explode(suffix)).withColumn("_prefix", F.explode(prefix)).select(
        *addresses.columns, "_suffix", "_prefix"
    )


def judge(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row.

    A rule fits its host and all hosts below it if the path starts with the rule's path. The longest fitting rule wins,
    host and path together; of equally long ones that with the longer host, then ``block``. Without one the rule is null
    and the verdict is ``otherwise``. Rules that are given twice count once; a rule without a host fits nothing.
    """
    known = rules.filter("rule_host != ''").select("verdict", lowered(F.col("rule_host")).alias("rule_host"), "rule_path").distinct()
    digests = known.withColumn("_full", _expression(F.col("rule_host"), F.col("rule_path"))).withColumn("_short", F.substring("_full", 1, PREFIX))
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("_url")).select(
        "page_id", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path")
    )
    # Equal addresses are judged once.
    addresses = rows.select("host", "path").distinct()
    expanded = expressions(addresses, known).withColumn("_digest", _expression(F.col("_suffix"), F.col("_prefix"))).withColumn(
        "_short", F.substring("_digest", 1, PREFIX)
    )
    hits = expanded.join(digests, "_short").filter("_digest = _full")
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), F.col("verdict"),
            F.concat("rule_host", "rule_path").alias("rule"),
        )).alias("best")
    )
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict")
    )
