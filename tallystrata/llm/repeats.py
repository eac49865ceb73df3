"""Repeated substrings across and within documents, by longest-previous-factor arrays.

Suffixes are dealt out by content: the ``length`` bytes after a start contain a gram with the smallest hash, and equal
strings have it at the same distance, so all starts that could match share the gram's fingerprint. Neighbouring starts
with the same gram form one segment, and a fingerprint that occurs once cannot match. If all segments of a fingerprint
are equal, they are copies. Otherwise the distinct segments are brought together, a bounded number of them to a task:
their suffixes are sorted, and each suffix's longest earlier match is the larger of the common prefixes with the next
suffix in either direction of the order that starts earlier in the text; the same with later ones. A fingerprint with
more than ``CROWD`` different segments has its starts dealt out singly by the digest of their ``length`` bytes instead,
which gives the same answer however many there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystrata.llm import bloom, text as tx
from tallystrata.sources.scratch import stored

LENGTH = 200
#: Different segments of one fingerprint that are sorted together, and segments of an average task. A task sorts at most
#: about CROWD + TASK segments of some 50 suffixes of LENGTH bytes, some 60 MB, and holds three arrays of that size.
CROWD, TASK = 4096, 2048
#: Starts handled at once within a long text.
PIECE = 1 << 21
_POS = np.uint64(24)


def runs(raw: np.ndarray, offsets: np.ndarray, length: int):
    """(fingerprint, segment digest, first start, last start) of each segment, in text order; starts count from the slice."""
    gram = max(length // 2, 1)
    width = length - gram + 1
    found = []
    for low in range(0, max(len(raw) - length + 1, 0), PIECE):
        part = raw[low : low + PIECE + length - 1]
        n = len(part)
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(tx.BYTE_VALUE[part] * tx.powers(tx.BASE, n), out=sums[1:])
        inverse = tx.powers(tx.BASE_INVERSE, n)
        hashed = tx.mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
        # The position decides between equal grams: the leftmost counts.
        key = (hashed >> _POS << _POS) | np.arange(len(hashed), dtype=np.uint64)
        blocks = -(-len(key) // width)
        padded = np.full(blocks * width, np.uint64(2**64 - 1))
        padded[: len(key)] = key
        grid = padded.reshape(blocks, width)
        ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        starts = n - length + 1
        least = (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & np.uint64((1 << 24) - 1)).astype(np.int64)
        valid = np.ones(starts, dtype=bool)
        # The last length - 1 bytes of each document start nothing.
        for end in offsets[1:][(offsets[1:] > low) & (offsets[1:] < low + n)] - low:
            valid[max(end - length + 1, 0) : end] = False
        at = np.flatnonzero(valid)
        if not len(at):
            continue
        place = least[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        a, b, p = at[first], at[last], place[first]
        digest = tx.mix((sums[b + length] - sums[a]) * inverse[a] + tx.mix(((b - a) * 65536 + (p - a)).astype(np.uint64)))
        found.append((hashed[p], digest, a + low, b + low))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def longest_previous(lcp: np.ndarray, place: np.ndarray, least: int) -> np.ndarray:
    """For suffixes in sorted order: the longest match that starts at a smaller ``place``, or 0 if below ``least``.

    ``lcp[i]`` is the common prefix of the suffixes i - 1 and i (``lcp[0]`` is 0). The previous and the next smaller places
    are found by jumping along pointers: all between a suffix and its pointer start later, so a pointer whose target also
    starts later moves on to the target's own pointer.
    """

    def towards(order_lcp, order_place):
        n = len(order_place)
        target = np.arange(n) - 1
        match = order_lcp.copy()
        target[match < least] = -1
        todo = np.flatnonzero(target >= 0)
        while len(todo):
            todo = todo[order_place[target[todo]] > order_place[todo]]
            over = target[todo]
            match[todo] = np.minimum(match[todo], match[over])
            target[todo] = np.where(match[todo] < least, -1, target[over])
            todo = todo[target[todo] >= 0]
        return np.where(target >= 0, match, 0)

    down = towards(lcp, place)
    up = towards(np.append(lcp[1:], 0)[::-1], place[::-1])[::-1]
    return np.maximum(down, up)


def matched_starts(segments: list[bytes], place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, has an earlier match, has a later match) for every start of the segments; ``place`` is each segment's rank."""
    sizes = np.array([len(s) - length + 1 for s in segments])
    raw = np.frombuffer(b"".join(segments), dtype=np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes + length - 1)[:-1]])
    segment = np.repeat(np.arange(len(segments)), sizes)
    start = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    suffix = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, length)[base[segment] + start])
    rank = place[segment] * (int(sizes.max()) + 1) + start
    order = np.lexsort((rank, np.unique(suffix.view(f"S{length}").reshape(-1), return_inverse=True)[1]))
    ordered = suffix[order]
    differ = ordered[1:] != ordered[:-1]
    lcp = np.zeros(len(order), dtype=np.int64)
    lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    before, after = np.empty((2, len(order)), dtype=bool)
    before[order] = longest_previous(lcp, rank[order], length) >= length
    after[order] = longest_previous(lcp, -rank[order], length) >= length
    return segment, start, before, after


def _ranges(sorted_starts: np.ndarray) -> list[tuple[int, int]]:
    if not len(sorted_starts):
        return []
    cut = np.flatnonzero(np.diff(sorted_starts) != 1)
    return list(zip(sorted_starts[np.append(0, cut + 1)].tolist(), sorted_starts[np.append(cut, len(sorted_starts) - 1)].tolist()))


_RANGES = "array<struct<s:int,e:int>>"


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
    ).withColumn("_key", F.xxhash64("_id", "_text"))


def _fingerprints(plain: DataFrame, length: int) -> DataFrame:
    """``f, mixed``: repeated fingerprints and whether their segments differ."""

    def count(batches):
        for batch in batches:
            for _, _, raw, offsets in tx.slices(batch.column(0)):
                f, seg, _, _ = runs(raw, offsets, length)
                pair, n = np.unique(np.stack([f, seg], axis=1).view("V16").reshape(-1), return_counts=True) if len(f) else (f, f)
                pair = np.ascontiguousarray(pair).view(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()), pa.array(np.asarray(n, dtype=np.int64))], names=["f", "seg", "n"]
                )

    rows = plain.select("_text").mapInArrow(count, "f bigint, seg bigint, n bigint")
    return rows.groupBy("f").agg(
        F.sum("n").alias("n"), F.min("seg").alias("lo"), F.max("seg").alias("hi")
    ).filter("n > 1").select("f", (F.col("lo") != F.col("hi")).alias("mixed"))


def _occurrences(plain: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """``f, seg, mixed, _id, _key, a, b``: all segments with a repeated fingerprint; a and b are the first and last start."""
    passing = plain.sparkSession.sparkContext.broadcast(bloom.bitmap(repeated, "f"))
    id_type = plain.schema["_id"].dataType.simpleString()

    def find(batches):
        for batch in batches:
            for i, j, raw, offsets in tx.slices(batch.column(1)):
                f, seg, a, b = runs(raw, offsets, length)
                keep = bloom.hits(passing.value, f)
                f, seg, a, b = f[keep], seg[keep], a[keep], b[keep]
                doc = np.searchsorted(offsets, a, side="right") - 1
                # Empty documents share their offset with the next one; the search gives the last, which is not empty.
                rows = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tx.signed(f)), pa.array(tx.signed(seg)), batch.column(0).take(rows), batch.column(2).take(rows),
                     pa.array((a - offsets[doc]).astype(np.int32)), pa.array((b - offsets[doc]).astype(np.int32))],
                    names=["f", "seg", "_id", "_key", "a", "b"],
                )

    found = plain.mapInArrow(find, f"f bigint, seg bigint, _id {id_type}, _key bigint, a int, b int")
    return found.join(repeated, "f")


def _only(plain: DataFrame, keys: DataFrame, inside: bool = True) -> DataFrame:
    """Rows of ``plain`` whose key passes (or fails) a filter of ``keys``, without a shuffle."""
    passing = plain.sparkSession.sparkContext.broadcast(bloom.bitmap(keys, "_key"))
    at = plain.columns.index("_key")

    def pick(batches):
        for batch in batches:
            near = bloom.hits(passing.value, batch.column(at).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(near if inside else ~near))

    return plain.mapInArrow(pick, plain.schema)


def _segment_matches(plain: DataFrame, mixed: DataFrame, length: int) -> DataFrame:
    """``f, seg, later, any``: ranges of starts (relative to the segment) that match an earlier, or any other, segment.

    ``mixed``: occurrences of fingerprints with different segments.
    """
    kinds = mixed.groupBy("f", "seg").agg(F.min(F.struct("_id", "_key", "a", "b")).alias("at"), F.count("*").alias("n"))
    kinds = stored(kinds.select("f", "seg", "at.*"), "kinds")
    crowd = kinds.groupBy("f").agg(F.count("*").alias("crowd"))
    wanted = kinds.groupBy("_key").agg(F.collect_list(F.struct("f", "seg", "a", "b")).alias("wanted"))
    texts = _only(plain.select("_text", "_key"), kinds.select("_key")).join(wanted, "_key").dropDuplicates(["_key"])

    def cut(batches):
        for batch in batches:
            rows = []
            for k, (raw, want) in enumerate(zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist())):
                raw = raw.as_py()
                rows += [(w["f"], w["seg"], raw[w["a"] : w["b"] + length]) for w in want]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], names=["f", "seg", "piece"]) if rows else pa.RecordBatch.from_pylist([], pa.schema([("f", pa.int64()), ("seg", pa.int64()), ("piece", pa.binary())]))

    pieces = texts.select("_text", "wanted").mapInArrow(cut, "f bigint, seg bigint, piece binary")
    ready = stored(
        pieces.join(kinds, ["f", "seg"]).join(crowd, "f").select("f", "seg", "piece", "_id", "_key", "a", "crowd"), "pieces"
    )
    few = ready.filter(F.col("crowd") <= CROWD)
    tasks = max(1, -(-few.count() // TASK))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_id", "ascending"), ("_key", "ascending"), ("a", "ascending")])
        segment, start, before, after = matched_starts(table["piece"].to_pylist(), np.arange(len(table)), length)
        cuts = np.searchsorted(segment, np.arange(len(table) + 1))
        later, every = [], []
        for x, y in zip(cuts[:-1], cuts[1:]):
            own = start[x:y]
            later.append([{"s": s, "e": e} for s, e in _ranges(own[before[x:y]])])
            every.append([{"s": s, "e": e} for s, e in _ranges(own[before[x:y] | after[x:y]])])
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        return pa.table({"f": table["f"], "seg": table["seg"], "later": pa.array(later, kind), "any": pa.array(every, kind)})

    sorted_out = few.withColumn("task", F.pmod(F.xxhash64("f"), F.lit(tasks))).groupBy("task").applyInArrow(
        compare, f"f bigint, seg bigint, later {_RANGES}, any {_RANGES}"
    )

    def starts(batches):
        for batch in batches:
            for f, seg, piece in zip(batch["f"].to_numpy(), batch["seg"].to_numpy(), batch["piece"].to_pylist()):
                raw = np.frombuffer(piece, dtype=np.uint8)
                n = len(raw)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tx.BYTE_VALUE[raw] * tx.powers(tx.BASE, n), dtype=np.uint64)])
                digest = tx.mix((sums[length:] - sums[:-length]) * tx.powers(tx.BASE_INVERSE, n)[: n - length + 1])
                count = len(digest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, f)), pa.array(np.full(count, seg)), pa.array(np.arange(count, dtype=np.int32)), pa.array(tx.signed(digest))],
                    names=["f", "seg", "start", "digest"],
                )

    many = ready.filter(F.col("crowd") > CROWD)
    single = many.select("f", "seg", "piece").mapInArrow(starts, "f bigint, seg bigint, start int, digest bigint").join(
        many.select("f", "seg", "_id", "_key", "a"), ["f", "seg"]
    )
    place = F.struct("_id", "_key", (F.col("a") + F.col("start")).alias("at"))
    group = single.groupBy("f", "digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    hit = single.join(group, ["f", "digest"]).select("f", "seg", "start", (place != F.col("first")).alias("again"))
    one = F.struct(F.col("start").alias("s"), F.col("start").alias("e"))
    dealt_out = hit.groupBy("f", "seg").agg(
        F.collect_list(F.when(F.col("again"), one)).alias("later"), F.collect_list(one).alias("any")
    )
    return sorted_out.unionByName(dealt_out)


def repeated_ranges(plain: DataFrame, length: int, keep: str) -> DataFrame:
    """``_key, spans``: ranges of starts (first, last) in each document whose ``length`` bytes are to go."""
    repeated = stored(_fingerprints(plain, length), "repeated")
    found = stored(_occurrences(plain, repeated, length), "occurrences")
    mixed = found.filter("mixed")
    matches = stored(_segment_matches(plain, mixed, length), "matches")
    # Equal segments in several places match each other as a whole; the smallest id and offset comes first.
    copies = found.groupBy("f", "seg").agg(F.count("*").alias("n"), F.min(F.struct("_id", "_key", "a")).alias("first"))
    rows = found.join(copies, ["f", "seg"]).join(matches, ["f", "seg"], "left")
    whole = F.array(F.struct(F.lit(0).alias("s"), (F.col("b") - F.col("a")).alias("e")))
    is_first = F.struct("_id", "_key", "a").eqNullSafe(F.col("first"))
    part = F.when((F.col("n") > 1) & (F.lit(keep == "none") | ~is_first), whole).otherwise(F.col("any" if keep == "none" else "later"))
    spans = rows.select("_key", "a", F.explode(part).alias("r")).select(
        "_key", F.struct((F.col("a") + F.col("r.s")).alias("s"), (F.col("a") + F.col("r.e")).alias("e")).alias("span")
    )
    return spans.groupBy("_key").agg(F.collect_set("span").alias("spans"))


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, keep: str = "first"
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: each text's UTF-8 bytes without repeated strings.

    A byte goes if a string of ``length`` bytes that covers it also starts somewhere else, in the same document or another.
    ``keep="first"`` spares the copy with the smallest id and offset, ``keep="none"`` removes every copy; all are judged on
    the input. ``kept`` is binary, as a cut may split a character. Null text is empty; texts shorter than ``length`` stay.
    Rows that share id and text count as two documents with ``keep="none"`` and as one place with ``keep="first"``.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    plain = _keyed(docs, id_column, text)
    ranges = stored(repeated_ranges(plain, length, keep), "ranges")
    raw = F.encode("_text", "utf-8")
    zero = F.lit(0).cast("bigint")
    clean = _only(plain, ranges, inside=False).select(
        F.col("_id").alias("doc_id"), F.octet_length("_text").cast("bigint").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), raw.alias("kept")
    )
    touched = _only(plain, ranges).join(ranges, "_key", "left").select("_id", "_text", "spans")
    id_type = plain.schema["_id"].dataType.simpleString()

    def remove(batches):
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for value, spans in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                value = value.as_py()
                change = np.zeros(len(value) + 1, dtype=np.int64)
                for span in spans or ():
                    change[span["s"]] += 1
                    change[span["e"] + length] -= 1
                gone = np.cumsum(change[:-1]) > 0
                n_bytes.append(len(value))
                n_removed.append(int(gone.sum()))
                n_spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
                kept.append(np.frombuffer(value, dtype=np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return clean.unionByName(touched.mapInArrow(remove, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"))
