"""Near duplicates: circulant MinHash, banding, and exact Jaccard similarity of the full shingle sets.

Two permutations of the 32-bit numbers make the whole signature: the first one scatters the shingles, the second one is
shifted by one place for each further coordinate, and the smallest value is kept.

Each different shingle set is one vertex, whatever the ids of its documents. In each bucket of equal bands the vertex that
shares most buckets is the centre. Every vertex is first verified against its best centre only, which joins a group of
copies to one component; of the other centres only those of another component are verified after that. What a bucket still
leaves unconnected is compared within its cluster of buckets in blocks, of which only links come out, so no list of all
pairs of a group ever exists.

With 28 bands of 4 rows a pair at the threshold of 0.8 shares no band with a probability below one in two million.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystrata.llm import bloom, text as tx
from tallystrata.llm.components import components
from tallystrata.sources.scratch import stored

BANDS, ROWS = 28, 4
#: Documents of one side of a block.
BLOCK = 256
_M = np.uint32


def _spread(x: np.ndarray) -> np.ndarray:
    """Bijection of 32-bit integers (the finaliser of MurmurHash3)."""
    x = x ^ (x >> _M(16))
    x = x * _M(0x85EBCA6B)
    x = x ^ (x >> _M(13))
    x = x * _M(0xC2B2AE35)
    return x ^ (x >> _M(16))


def signatures(hashes: np.ndarray, bounds: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """One row per document with a shingle: ``coordinates`` minima."""
    filled = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(filled), coordinates), dtype=np.uint32)
    if len(filled):
        first = _spread((hashes >> np.uint64(32)).astype(np.uint32) * _M(0x9E3779B1))
        starts = bounds[filled]
        for k in range(coordinates):
            out[:, k] = np.minimum.reduceat(_spread(first - _M(k)), starts)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each document; equal keys of different bands differ."""
    n, k = signature.shape
    s = signature.reshape(n, k // rows, rows).astype(np.uint64)
    key = np.broadcast_to(tx.mix(np.arange(1, k // rows + 1, dtype=np.uint64)), (n, k // rows)).copy()
    for r in range(rows):
        key = tx.mix(key * np.uint64(tx.BASE) + s[:, :, r])
    return key


def _with_marks(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``_id, _text, _h, _k``: two 64-bit hashes tell the texts of an id, or of no id, apart."""
    value = F.col(text)
    return docs.select(F.col(id_column).alias("_id"), value.alias("_text"), *_marks(value))


def _marks(value) -> tuple:
    return F.xxhash64(value).alias("_h"), F.xxhash64(F.lit("second"), value).alias("_k")


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    """``id, h, k, n, set_id, bands``: hashes of the text, number of shingles, digest of the set, band keys (null without
    shingles)."""

    def sketch(batches):
        for batch in batches:
            for i, j, raw, offsets in tx.slices(batch.column(1)):
                hashes, bounds = tx.shingles(tx.words(raw, offsets), size)
                counts = np.diff(bounds)
                filled = counts > 0
                keys = band_keys(signatures(hashes, bounds))
                lists = np.concatenate([[0], np.cumsum(filled)]) * BANDS
                digests = [
                    hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
                    for a, b in zip(bounds[:-1], bounds[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), batch.column(3).slice(i, j - i),
                     pa.array(counts), pa.array(digests, pa.binary()), tx.lists(tx.signed(keys.reshape(-1)), lists)],
                    names=["id", "h", "k", "n", "set_id", "bands"],
                )

    return docs.mapInArrow(
        sketch, f"id {docs.schema['_id'].dataType.simpleString()}, h bigint, k bigint, n bigint, set_id binary, bands array<bigint>"
    )


def _sets(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """``v, set``: full sorted shingle sets of the vertices in ``wanted`` (v, and h, k of a text that has the set)."""
    passing = docs.sparkSession.sparkContext.broadcast(bloom.bitmap(wanted.select("h"), "h"))

    def sets(batches):
        for batch in batches:
            key = np.stack([column.to_numpy(zero_copy_only=False) for column in batch.columns[1:]], axis=1)
            # of equal texts one in each batch goes on
            once = np.zeros(len(key), dtype=bool)
            once[np.unique(key, axis=0, return_index=True)[1]] = True
            batch = batch.filter(pa.array(bloom.hits(passing.value, key[:, 0].copy()) & once))
            for i, j, raw, offsets in tx.slices(batch.column(0)):
                hashes, bounds = tx.shingles(tx.words(raw, offsets), size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i), tx.lists(tx.signed(hashes), bounds)],
                    names=["h", "k", "set"],
                )

    found = docs.select("_text", "_h", "_k").mapInArrow(sets, "h bigint, k bigint, set array<bigint>")
    # Grouped by the keys of the join, which needs no further exchange.
    return found.join(wanted, ["h", "k"]).groupBy("h", "k", "v").agg(F.first("set").alias("set")).select("v", "set")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; sizes ``na, nb`` rule out most of the others beforehand."""
    near_size = "100 * least(na, nb) >= {0} * greatest(na, nb)".format(percent)
    sized = pairs.filter(near_size).join(sets.select(F.col("v").alias("a"), F.col("set").alias("x")), "a")
    both = sized.join(sets.select(F.col("v").alias("b"), F.col("set").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(100 * common >= percent * (F.size("x") + F.size("y") - common)).select(*pairs.columns)


def _blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that the stars missed, between labels.

    ``members``: v, n, label, cluster, odd (not of the cluster's main label). Every odd document meets the whole cluster as
    far as the set sizes allow: sizes fall into classes a factor ``100 / percent`` wide, and only the own and the
    neighbouring classes can hold partners. Both sides are cut into blocks of about BLOCK documents.
    """
    kind = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)) + F.lit(1e-9)).cast("int")
    rows = members.withColumn("kind", kind)
    counts = rows.groupBy("cluster", "kind").agg(F.count("*").alias("all"), F.sum(F.col("odd").cast("bigint")).alias("odds"))
    per = counts.select(
        "cluster", "kind", F.ceil(F.col("all") / BLOCK).cast("bigint").alias("blocks"), F.col("odds")
    )
    reach = per.filter("odds > 0").select(
        "cluster", F.explode(F.array(F.col("kind") - 1, F.col("kind"), F.col("kind") + 1)).alias("kind"), "odds"
    ).groupBy("cluster", "kind").agg(F.sum("odds").alias("odds"))
    grid = per.drop("odds").join(reach, ["cluster", "kind"]).select(
        "cluster", "kind", "blocks", F.ceil(F.col("odds") / BLOCK).cast("bigint").alias("odd_blocks")
    )
    place = F.pmod(F.xxhash64("v"), F.lit(1 << 40))
    left = rows.join(grid, ["cluster", "kind"]).select(
        "cluster", "kind", (place % F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("odd_blocks") - 1)).alias("odd_block"), "v", "label", F.lit(False).alias("odd"),
    )
    right = rows.filter("odd").withColumn("kind", F.explode(F.array(F.col("kind") - 1, F.col("kind"), F.col("kind") + 1))).join(
        grid, ["cluster", "kind"]
    ).select(
        "cluster", "kind", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
        (place % F.col("odd_blocks")).alias("odd_block"), "v", "label", F.lit(True).alias("odd"),
    )
    shipped = left.unionByName(right).join(sets, "v")

    def compare(table: pa.Table) -> pa.Table:
        odd = table["odd"].to_numpy(zero_copy_only=False)
        values = table["set"].combine_chunks()
        flat = values.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(np.diff(values.offsets.to_numpy()))
        begins = np.concatenate([[0], ends[:-1]])
        labels = table["label"].to_pylist()
        _, codes = np.unique(flat, return_inverse=True)
        ours = np.flatnonzero(~odd)
        out_a, out_b = [], []
        if len(ours) and odd.any():
            order = np.concatenate([np.arange(begins[i], ends[i]) for i in ours])
            ours_codes, sizes = codes[order], (ends - begins)[ours]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mark = np.zeros(codes.max() + 1, dtype=np.int64)
            for u in np.flatnonzero(odd):
                own = codes[begins[u] : ends[u]]
                mark[own] = 1
                common = np.add.reduceat(mark[ours_codes], starts)
                mark[own] = 0
                linked = 100 * common >= percent * (sizes + len(own) - common)
                told = set()
                for i in ours[linked]:
                    # One link to each component is enough to join it.
                    if labels[i] != labels[u] and labels[i] not in told:
                        told.add(labels[i])
                        out_a.append(labels[u])
                        out_b.append(labels[i])
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return shipped.groupBy("cluster", "kind", "block", "odd_block").applyInArrow(compare, "a bigint, b bigint")


def _relabelled(pairs: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the label of a vertex as ``out``; a vertex without one is its own."""
    known = labels.select(F.col("id").alias(column), F.col("label").alias(out))
    return pairs.join(known, column, "left").withColumn(out, F.coalesce(out, column))


def links(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(the sketches of all rows, ``set_id, head, label`` of each set: its first row, and the number of its component)."""
    sketched = stored(_sketches(docs, size), "sketch")
    # Equal sets have equal sizes and bands. Rows without an id come last. The numbers hold because they are written.
    heads = stored(
        sketched.filter("n > 0").groupBy("set_id").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h", "k")).alias("head"),
            F.first("n").alias("n"), F.first("bands").alias("bands"),
        ).withColumn("v", F.monotonically_increasing_id()), "heads",
    )
    buckets = heads.select("v", "n", F.explode("bands").alias("band"))
    crowd = buckets.groupBy("band").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    shared = stored(buckets.join(crowd, "band"), "shared")
    fame = shared.groupBy("v").agg(F.sum("crowd").alias("fame"))
    famed = shared.join(fame, "v")
    centre = famed.groupBy("band").agg(F.max(F.struct("fame", "v", "n")).alias("c"))
    stars = stored(
        shared.join(centre, "band").filter("v != c.v").select(
            F.col("v").alias("a"), F.col("c.v").alias("b"), F.col("n").alias("na"), F.col("c.n").alias("nb"), F.col("c.fame").alias("fame")
        ).distinct(), "stars",
    )
    wanted = heads.select("v", "head.h", "head.k").join(shared.select("v").distinct(), "v", "left_semi")
    sets = stored(_sets(docs, size, wanted), "sets")
    best = stars.groupBy("a").agg(F.max(F.struct("fame", "b", "na", "nb")).alias("best")).select("a", "best.b", "best.na", "best.nb")
    first = stored(components(_verified(best, sets, percent).select("a", "b"))[0], "first")
    # A group of copies is one vertex from here on.
    apart = _relabelled(_relabelled(stars.drop("fame"), first, "a", "la"), first, "b", "lb").filter("la != lb")
    apart = stored(apart, "apart")
    classes = _relabelled(heads.select("set_id", "head", "n", "v"), first, "v", "label")
    if apart.isEmpty():
        return sketched, classes.select("set_id", "head", "label")
    close = _verified(apart, sets, percent).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    close = stored(close, "close")
    candidates = apart.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    labels, clusters = (stored(found, "second") for found in components(close, candidates))
    members = classes.join(clusters.select(F.col("id").alias("label"), F.col("label").alias("cluster")), "label").select(
        "v", "n", "cluster", "label"
    )
    members = _relabelled(members, labels, "label", "now").drop("label").withColumnRenamed("now", "label")
    by_label = members.groupBy("cluster", "label").agg(F.count("*").alias("many"))
    main = by_label.groupBy("cluster").agg(
        F.max_by("label", F.struct(F.col("many"), F.col("label"))).alias("main"), F.count("*").alias("labels")
    ).filter("labels > 1")
    open_members = stored(
        members.join(main, "cluster").select("v", "n", "label", "cluster", (F.col("label") != F.col("main")).alias("odd")), "open"
    )
    more = stored(_blocks(open_members, sets, percent).distinct(), "more")
    last = stored(components(more)[0], "third")
    classes = _relabelled(classes, labels, "label", "second")
    return sketched, _relabelled(classes, last, "second", "third").select("set_id", "head", F.col("third").alias("label"))


def _found(docs: DataFrame, id_column: str, text: str, size: int, percent: int) -> DataFrame:
    """Every row's ``id, h, k, n`` and the first row of its component, ``top`` (no_id, id, h, k; null without shingles)."""
    sketched, classes = links(_with_marks(docs, id_column, text), size, percent)
    tops = classes.groupBy("label").agg(F.min("head").alias("top"))
    by_set = classes.select("set_id", "label").join(tops, "label").select("set_id", "top")
    return sketched.select("id", "h", "k", "n", "set_id").join(by_set, "set_id", "left").drop("set_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Words are runs without ASCII white space, A-Z lowered; a text with fewer than ``size`` words has its whole sequence as
    its only shingle; a text without words (or null) has none and is linked with nothing. Sets are linked when their
    Jaccard similarity is at least ``percent`` / 100; ``component_id`` is the smallest id reachable, where a null id comes
    last, and ``kept`` says whether the row has that id. Rows that repeat an id are judged by their own texts; all rows of a
    component that share its smallest id are marked kept. Other columns are not read.
    """
    found = _found(docs, id_column, text, size, percent)
    component = F.when(F.col("top").isNull(), F.col("id")).otherwise(F.col("top.id"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns: all without words, and one row of each component.

    That is the row with the smallest id (null ids come last; of different texts under that id, one). Rows that repeat both
    id and text count as one, of which any stays. A text is dropped only for a similar one, never for its id.
    """
    found = _found(docs, id_column, text, size, percent).filter("n > 0")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "h", "k").eqNullSafe(F.col("top"))
    rows = found.select("id", "h", "k", first.alias("first")).groupBy("id", "h", "k").agg(F.max("first").alias("first"), F.count("*").alias("many"))
    # ``many``: 0 for rows that go
    told = stored(
        rows.filter("not first or many > 1").select(
            F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("k").alias("_k"), F.col("first").alias("_first")
        ), "told",
    )
    # Most rows are told by their hash alone to stay, and do not move.
    alone, maybe = bloom.apart(docs, _marks(docs[text])[0], told, "_h")
    h, k = _marks(maybe[text])
    same = maybe[id_column].eqNullSafe(told["_id"]) & (h == told["_h"]) & (k == told["_k"])
    passing = alone.unionByName(maybe.join(told, same, "left_anti"))
    repeated = told.filter("_first")
    if repeated.isEmpty():
        return passing
    return passing.unionByName(maybe.join(repeated, same, "left_semi").dropDuplicates([id_column, text]))
