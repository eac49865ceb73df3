"""Mixing sources to target weights by Pfair scheduling.

Native functions only. Think of all sources as flowing at once, each at the rate of its weight among the sources that are not
used up. Block i of a source with weight w flows between the rounds i / w and (i + 1) / w, and by round v there have been
T(v) = sum of min(w * v, blocks) slots. Its release is floor(T(i / w)), its deadline ceil(T((i + 1) / w)), and each slot goes
to the released block with the earliest deadline. Such a schedule meets all deadlines, so after any number of slots each
source is less than one block away from what has flowed: w * t / (sum of w) until the first source ends, and the same from
there on among the rest. Weights are used as they are given; nothing is rounded to periods.

The slots are found without going from one to the next. Blocks of earlier deadline do not wait for later ones, so the slots
that the earlier half of a group uses follow from releases alone (running maximum), the later half has the others, and both
halves go on in the same way: as many rounds as the number of blocks has bits, whatever the number of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystrata.sources.scratch import stored

#: Rows of a block.
BLOCK = 64
#: Slots this near to a whole number count as whole, as rounds and weights are doubles.
NEAR = 1e-6
#: Rows of a hash range that is numbered by one task, and ranges whose counts are added up by one task.
RANGE, RANGES = 500, 1000
_HASHES = 1 << 32


def place(id_column: Column) -> Column:
    """Uniform 32-bit place of a row within its source; null ids come first."""
    return F.coalesce(F.conv(F.substring(F.md5(id_column.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def numbered(docs: DataFrame, id_column: str, source: str) -> DataFrame:
    """``docs`` with ``_row``, numbering each source from 0 by the hash of the id; a large source is cut into hash ranges.

    Rows that tie in hash and id get different numbers in any order.
    """
    sizes = docs.groupBy(source).agg(F.count("*").alias("_rows"))
    ranged = docs.join(sizes, docs[source].eqNullSafe(sizes[source])).select(docs["*"], "_rows").withColumn("_place", place(F.col(id_column)))
    ranged = ranged.withColumn("_range", F.floor(F.col("_place") * F.ceil(F.col("_rows") / RANGE) / _HASHES))
    counts = ranged.groupBy(source, "_range").agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_group", F.floor(F.col("_range") / RANGES))
    groups = counts.groupBy(source, "_group").agg(F.sum("_n").alias("_g"))
    over = lambda *keys: f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys[:-1])} ORDER BY {keys[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    groups = groups.select(source, "_group", F.expr(f"coalesce(sum(_g) {over(source, '_group')}, 0)").alias("_before_group"))
    counts = counts.select(
        source, "_group", "_range", F.expr(f"coalesce(sum(_n) {over(source, '_group', '_range')}, 0)").alias("_before")
    )
    starts = counts.join(groups, counts[source].eqNullSafe(groups[source]) & (counts["_group"] == groups["_group"])).select(
        counts[source].alias("_s"), counts["_range"].alias("_r"), (F.col("_before") + F.col("_before_group")).alias("_start")
    )
    inside = ranged.withColumn(
        "_in", F.expr(f"row_number() OVER (PARTITION BY `{source}`, _range ORDER BY _place, `{id_column}`) - 1")
    )
    return inside.join(starts, inside[source].eqNullSafe(starts["_s"]) & (inside["_range"] == starts["_r"])).select(
        *docs.columns, (F.col("_start") + F.col("_in")).alias("_row")
    )


def weighted(sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """``source, blocks, weight``. ``sizes``: source, blocks; ``weights``: source, weight.

    A source without a weight, or with one that is null, not above 0 or not finite, has the smallest of the others.
    """
    usable = weights.filter((F.col("weight") > 0) & (F.col("weight") < float("inf")))
    usable = usable.select(F.col("source").alias("_w"), F.col("weight").cast("double").alias("weight"))
    matched = sizes.join(usable, F.col("source").eqNullSafe(F.col("_w")), "left")
    return matched.select("source", "blocks", F.coalesce("weight", usable.agg(F.min("weight")).scalar(), F.lit(1.0)).alias("weight"))


def windows(planned: DataFrame) -> DataFrame:
    """``source, i, release, deadline`` of every block. ``planned``: source, blocks, weight; one row for each source."""
    # One row for each round in which a block begins or its source ends.
    rounds = planned.select("source", "blocks", "weight", F.explode(F.sequence(F.lit(0).cast("bigint"), "blocks")).alias("i"))
    rounds = rounds.withColumn("v", F.col("i") / F.col("weight")).withColumn("last", F.col("i") == F.col("blocks"))
    order = Window.orderBy("v", "source", "i")
    back = Window.orderBy(F.desc("v"), F.desc("source"), F.desc("i"))
    before = F.sum(F.when(F.col("last"), F.col("blocks")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # Added up from the end, so that small weights keep their digits beside large ones that have ended.
    active = F.coalesce(F.sum(F.when(F.col("last"), F.col("weight")).otherwise(0.0)).over(back.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    flowed = rounds.withColumn("before", before).withColumn("t", F.col("before") + F.col("v") * active)
    ends = F.lead("t").over(Window.partitionBy("source").orderBy("i"))
    return flowed.withColumn("end", ends).filter(~F.col("last")).select(
        "source", "i", F.floor(F.col("t") + NEAR).alias("release"), F.ceil(F.col("end") - NEAR).alias("deadline")
    )


def earliest_first(jobs: DataFrame, n: int) -> DataFrame:
    """``rank, slot``: each slot from 0 goes to the released job of the lowest rank.

    ``jobs``: rank (0 to n - 1), release. No slot may be idle, which the caller has to see to.
    """
    slots = jobs.sparkSession.range(n).select(F.lit(0).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("rank"), F.col("id").alias("slot"), F.col("id").alias("pos"))
    rows = slots.unionByName(jobs.select(F.lit(0).cast("bigint").alias("node"), "rank", F.lit(None).cast("bigint").alias("slot"), F.col("release").alias("pos")))
    # A node has the jobs whose ranks agree in their upper bits and as many slots, numbered from 0; ``pos`` is a slot's number
    # or the first slot of the node in which the job is released.
    for half in reversed(range((n - 1).bit_length() if n else 0)):
        bit = F.shiftright("rank", half).bitwiseAND(F.lit(1).cast("bigint"))
        rows = rows.repartition("node").withColumn("early", F.coalesce(bit == 0, F.lit(False)))
        queue = Window.partitionBy("node", "early").orderBy("pos", "rank", "slot")
        rows = rows.withColumn("k", F.row_number().over(queue) - 1)
        rows = rows.withColumn("used", F.col("k") + F.max(F.col("pos") - F.col("k")).over(queue.rowsBetween(Window.unboundedPreceding, 0)))
        # Each early job adds a mark at a slot that the early jobs use.
        at = lambda place, mark: F.struct(F.col(place).cast("bigint").alias("pos"), F.lit(mark).alias("mark"))
        marked = rows.select("node", "rank", "slot", F.explode(F.when(F.col("early"), F.array(at("pos", 0), at("used", 1))).otherwise(F.array(at("pos", 0)))).alias("x"))
        line = Window.partitionBy("node").orderBy("pos")
        marked = marked.select("node", "rank", "slot", "x.pos", "x.mark").withColumn(
            "before", F.coalesce(F.sum("mark").over(line.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ).withColumn("upto", F.sum("mark").over(line.rangeBetween(Window.unboundedPreceding, 0)))
        later = F.when(F.col("slot").isNull(), bit).otherwise((F.col("upto") == F.col("before")).cast("bigint"))
        rows = marked.filter("mark = 0").withColumn("later", later).select(
            (F.col("node") * 2 + F.col("later")).alias("node"), "rank", "slot",
            F.when(F.col("later") == 0, F.col("before")).otherwise(F.col("pos") - F.col("before")).alias("pos"),
        )
    return rows.filter("slot IS NOT NULL").select(F.col("node").alias("rank"), "slot")


def schedule(planned: DataFrame) -> DataFrame:
    """``source, i, slot``: the slot of every block in the whole mix. ``planned``: source, blocks, weight."""
    ranked = windows(planned).withColumn("rank", F.row_number().over(Window.orderBy("deadline", "release", "source", "i")).cast("bigint") - 1)
    ranked = stored(ranked, "blocks")
    return ranked.join(earliest_first(ranked.select("rank", "release"), ranked.count()), "rank").select("source", "i", "slot")


def mix(docs: DataFrame, weights: DataFrame, id_column: str = "doc_id", source: str = "source", block: int = BLOCK) -> DataFrame:
    """``docs`` with ``block`` (its number within the source) and ``position`` (the block's slot in the whole mix).

    No row is dropped or repeated. ``weights`` has ``source`` and ``weight``; of a source that it lists twice the largest
    weight counts. Null is a source of its own. Blocks have ``block`` rows but for each source's last one, rows in the order
    of a hash of the id; ids may be null or recur. Columns of ``docs`` that have the new names are replaced.
    """
    docs = docs.drop("block", "position")
    own = [F.col(f"`{c}`") for c in docs.columns]
    # whole rows travel in one column, so that none of theirs meets a name of the schedule
    packed = docs.select(F.struct(*own).alias("_doc"), F.col(id_column).alias("_id"), F.col(source).alias("_source"))
    sizes = packed.groupBy(F.col("_source").alias("source")).agg(F.ceil(F.count("*") / block).alias("blocks"))
    weights = weights.groupBy("source").agg(F.max("weight").alias("weight"))
    plan = schedule(weighted(sizes, weights)).select(F.col("source").alias("_s"), F.col("i").alias("_i"), F.col("slot").alias("_slot"))
    rows = numbered(packed, "_id", "_source").withColumn("_block", F.floor(F.col("_row") / block))
    return rows.join(plan, rows["_source"].eqNullSafe(plan["_s"]) & (rows["_block"] == plan["_i"])).select(
        "_doc.*", F.col("_block").alias("block"), F.col("_slot").alias("position")
    )
