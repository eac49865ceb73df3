"""Benchmark items inside documents: size-partitioned MinHash containment search, verified by exact containment.

Items are partitioned by the number of their shingles, sizes of one power of two together. Each partition has one sketch
length, set from its largest size so that a document holding the wanted share of an item must hold at least one shingle
of the item's sketch, its smallest hashes; documents are never sketched, so however long one is, no small item is missed.
A document without a sketch shingle sends nothing. Partition by partition, sketch shingles that a document shares with an
item make the two a candidate pair once there are as many as the wanted share leaves no way around; only candidate
pairs are then counted on all shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystrata.llm import bloom, text as tx
from tallystrata.sources.scratch import stored

SIZE, PERCENT = 5, 80


def sketch_length(n: int, percent: int = PERCENT) -> int:
    """Shingles that an item of ``n`` needs in its sketch, by the largest size of its partition; never more than ``n``."""
    largest = (1 << int(n).bit_length()) - 1
    return min(n, largest - -(-largest * percent // 100) + 1)


def sketch_share(n: int, percent: int = PERCENT) -> int:
    """Shingles of its sketch that a document with ``percent`` of an item's ``n`` shingles holds at least; one or more."""
    return sketch_length(n, percent) - (n - -(-n * percent // 100))


def _grams(raw: np.ndarray, offsets: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Each document's distinct shingles of all the sizes; those of different sizes have different hashes."""
    w = tx.words(raw, offsets, tx.PUNCTUATION)
    out = [[] for _ in range(len(offsets) - 1)]
    for size in sizes:
        hashes, bounds = tx.shingles(w, size)
        for d in np.flatnonzero(np.diff(w.first) >= size):
            out[d].append(tx.mix(hashes[bounds[d] : bounds[d + 1]] + np.uint64(size)))
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


def item_shingles(items: DataFrame, id_column: str, text: str, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``item, n, width, part, share, shingle, sketch``: an item with fewer than ``size`` words is one shingle of that many
    words. ``part`` is the partition by size, ``share`` the least number of sketch shingles in a document that holds the item."""
    id_type = items.schema[id_column].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            rows = []
            ids = batch.column(0).to_pylist()
            for i, _, raw, offsets in tx.slices(batch.column(1)):
                counts = np.diff(tx.words(raw, offsets, tx.PUNCTUATION).first)
                by_size = {k: _grams(raw, offsets, [int(k)]) for k in np.unique(np.minimum(counts, size)) if k}
                for d, c in enumerate(counts):
                    if c:
                        own = np.sort(by_size[min(c, size)][d])
                        k, share = sketch_length(len(own), percent), sketch_share(len(own), percent)
                        rows += [
                            (ids[i + d], len(own), int(min(c, size)), len(own).bit_length(), share, int(x), r < k)
                            for r, x in enumerate(own.view(np.int64))
                        ]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("item", "n", "width", "part", "share", "shingle", "sketch"), r)) for r in rows],
                pa.schema([("item", batch.column(0).type), ("n", pa.int64()), ("width", pa.int32()), ("part", pa.int32()), ("share", pa.int64()), ("shingle", pa.int64()), ("sketch", pa.bool_())]),
            )

    lowered = items.select(id_column, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    return lowered.mapInArrow(cut, f"item {id_type}, n bigint, width int, part int, share bigint, shingle bigint, sketch boolean")


def contained_items(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = SIZE, percent: int = PERCENT,
) -> DataFrame:
    """``_key, item, n, common``: items of which a document holds at least ``percent`` of the distinct shingles.

    ``_key`` is ``xxhash64(id, text)`` of the document. Words are runs of anything but ASCII punctuation and white space,
    in lower case. Items without a word are in no document; items with equal shingles are searched once.
    """
    cut = stored(item_shingles(items, item_id, item_text, size, percent).distinct(), "items")
    sets = cut.groupBy("item").agg(F.array_sort(F.collect_list("shingle")).alias("set"))
    classes = stored(sets.groupBy("set").agg(F.min("item").alias("head"), F.collect_list("item").alias("items")).drop("set"), "classes")
    rows = cut.join(classes.select(F.col("head").alias("item")), "item", "left_semi")
    widths = sorted(r["width"] for r in cut.select("width").distinct().collect())
    context = docs.sparkSession.sparkContext
    in_sketch = context.broadcast(bloom.bitmap(rows.filter("sketch"), "shingle"))
    in_items = context.broadcast(bloom.bitmap(rows, "shingle"))
    keyed = docs.select(F.xxhash64(id_column, text).alias("_key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_text"))

    def find(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for i, _, raw, offsets in tx.slices(batch.column(1)):
                found, whose, marked = [], [], []
                for d, own in enumerate(_grams(raw, offsets, widths)):
                    if len(own) and bloom.hits(in_sketch.value, own).any():
                        own = own[bloom.hits(in_items.value, own)]
                        found.append(own)
                        whose.append(np.full(len(own), keys[i + d]))
                        marked.append(bloom.hits(in_sketch.value, own))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(whose)), pa.array(tx.signed(np.concatenate(found))), pa.array(np.concatenate(marked))],
                        names=["_key", "shingle", "_marked"],
                    )

    # Equal rows send equal shingles, which count once.
    seen = stored(keyed.mapInArrow(find, "_key bigint, shingle bigint, _marked boolean").distinct(), "shingles")
    sketches = rows.filter("sketch").select("part", "item", "n", "share", "shingle")
    candidates = seen.filter("_marked").join(sketches, "shingle").groupBy("_key", "part", "item", "n", "share").agg(F.count("*").alias("held")).filter("held >= share")
    # Every candidate brings each shingle of its item once, however many documents and items share that shingle.
    wanted = candidates.select("_key", "item", "n").join(rows.select("item", "shingle"), "item")
    counted = wanted.join(seen.select("_key", "shingle"), ["_key", "shingle"]).groupBy("_key", "item", "n").agg(F.count("*").alias("common"))
    return counted.filter(100 * F.col("common") >= percent * F.col("n")).join(classes.withColumnRenamed("head", "item"), "item").select(
        "_key", F.explode("items").alias("item"), "n", "common"
    )


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id, contaminated, n_items, item_ids, containment`` for every row; the ids ascend, containment is the largest share.

    Rows that share id and text get the same result; a null text holds no item.
    """
    found = contained_items(docs, items, id_column, text, **options).groupBy("_key").agg(
        F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("item_ids"), F.max(F.col("common") / F.col("n")).alias("containment")
    )
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(id_column, text).alias("_key"))
    kind = found.schema["item_ids"].dataType
    return rows.join(found, "_key", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("item_ids", F.array().cast(kind)).alias("item_ids"), F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item. Texts are exchanged only where a filter of the found keys lets them pass."""
    found = stored(contained_items(docs, items, id_column, text, **options).select(F.col("_key").alias("_bad")).distinct(), "contaminated")
    clean, maybe = bloom.apart(docs, F.xxhash64(id_column, text), found, "_bad")
    return clean.unionByName(maybe.join(found, F.xxhash64(maybe[id_column], maybe[text]) == found["_bad"], "left_anti"))
