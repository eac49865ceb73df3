"""Exact duplicates by two-pass Bloom filtering.

First pass: every document's normalised text is hashed and two slots of the hash are counted in a filter that grows with the
table and stays distributed; a slot that two documents hit is marked. Second pass: the marked slots, folded into a filter of
bounded size, are sent to all tasks; a document with an unmarked slot is certainly alone and passes straight through; only
the others are grouped by their SHA-256, so texts of single documents never move. How full the bounded filter gets depends
on the number of repeated texts and not on the number of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallystrata.llm import bloom, text as tx

#: Slots per row of the first filter, whatever the number of rows: at most an eighth of the slots of one key is hit by others,
#: so one single document in 64 has both marked.
SLOTS_PER_ROW = 16


def _digests(column: pa.Array) -> list[bytes]:
    sha = hashlib.sha256
    # bytes.lower() changes A-Z only.
    return [sha((x.as_buffer().to_pybytes() if x.is_valid else b"").lower()).digest() for x in column.cast(pa.binary())]


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 4)[:, 0].copy()


def slots_for(docs: DataFrame) -> int:
    """Size of the first filter: a power of two above ``SLOTS_PER_ROW`` for each row."""
    return max(64, 1 << int(SLOTS_PER_ROW * docs.count()).bit_length())


def slot_counts(docs: DataFrame, bits: int, text: str = "text") -> DataFrame:
    """``slot, n`` of a filter of ``bits``: how many hits each slot has. Only slot numbers move, summed within tasks first."""

    def count(batches):
        for batch in batches:
            # One document may hit the same slot with both parts of its key; that is not a repetition, but harmless.
            slot, n = np.unique(bloom.slots(_keys(_digests(batch.column(0))), bits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot.view(np.int64)), pa.array(n.astype(np.int64))], names=["slot", "n"])

    return docs.select(text).mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))


def repeated_slots(docs: DataFrame, text: str = "text", most: int = bloom.BITS) -> np.ndarray:
    """The slots that at least two documents hit, folded into a filter of at most ``most`` bits."""
    bits = slots_for(docs)
    repeated, small = slot_counts(docs, bits, text).filter("n > 1"), min(bits, most)
    return bloom.words_to_bits(repeated.select(F.col("slot").bitwiseAND(F.lit(small - 1)).alias("slot")), small)


def digested(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns, and their names: the digest of the normalised text, and whether another document may
    have the same one (false: certainly none has)."""
    seen = docs.sparkSession.sparkContext.broadcast(repeated_slots(docs, text))
    sha, maybe = tx.free_name(docs.columns, "_sha"), tx.free_name(docs.columns, "_maybe")
    schema = T.StructType(docs.schema.fields + [T.StructField(sha, T.BinaryType()), T.StructField(maybe, T.BooleanType())])
    at, names = docs.columns.index(text), [*docs.columns, sha, maybe]

    def add(batches):
        for batch in batches:
            digests = _digests(batch.column(at))
            hit = bloom.hits(seen.value, _keys(digests)) if digests else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(digests, pa.binary()), pa.array(hit)], names=names
            )

    return tx.numbered_columns(docs).mapInArrow(add, schema), sha, maybe


def _groups(maybe: DataFrame, id_column: str, sha: str) -> DataFrame:
    return maybe.groupBy(F.col(sha).alias("_digest")).agg(F.max(id_column).alias("_keep"), F.count("*").alias("_size"))


def classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``doc_id, keep_id, group_size, kept, text_sha256``; the largest id of equal texts stays.

    Texts are equal when they are after lower-casing A-Z only; null counts as empty. Of rows that share both text and the
    largest id all are marked kept. A null id is smaller than any other; a group with null ids only keeps them.
    """
    d = digested(docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")), "_text")[0].drop("_text")
    sha = F.lower(F.hex("_sha")).alias("text_sha256")
    alone = d.filter("not _maybe").select(
        F.col("_id").alias("doc_id"), F.col("_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), sha
    )
    maybe = d.filter("_maybe").drop("_maybe")
    grouped = maybe.join(_groups(maybe, "_id", "_sha").withColumnRenamed("_digest", "_sha"), "_sha").select(
        F.col("_id").alias("doc_id"), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), sha,
    )
    return alone.unionByName(grouped)


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``: of equal texts the row with the largest id (null ids come last), of
    rows equal in text and id any one. Null counts as empty."""
    d, sha, seen = digested(docs, text)
    maybe = d.filter(F.col(seen))
    keep = _groups(maybe, id_column, sha)
    # Both columns are join keys, so a large group is spread by its ids, and only the row that stays finds a partner.
    stay = maybe.join(keep, (maybe[sha] == keep["_digest"]) & maybe[id_column].eqNullSafe(keep["_keep"]), "left_semi")
    single = stay.dropDuplicates([sha, id_column])
    own = [F.col(f"`{c}`") for c in docs.columns]
    return d.filter(~F.col(seen)).select(*own).unionByName(single.select(*own))
