"""Bloom filters of a fixed number of bits. They only save work: whatever passes one by chance is told apart exactly afterwards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallystrata.llm.text import free_name

#: 2 ** 26 bits are 8 MB, the most that is broadcast whatever the input. A full filter lets everything pass.
BITS = 1 << 26


def positions(column: Column, bits: int) -> tuple[Column, Column]:
    """Two places for a 64-bit key, as :func:`hits` computes them."""
    return column.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(column, 32).bitwiseAND(F.lit(bits - 1))


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """Both places of each key in a filter of any power of two: the key and the key turned by 32 bits, modulo ``bits``.

    The places in a smaller filter are these modulo its size, so a large filter can be folded into a small one.
    """
    keys = keys.view(np.uint64)
    turned = (keys >> np.uint64(32)) | (keys << np.uint64(32))
    return np.concatenate([keys, turned]) & np.uint64(bits - 1)


def bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Filter of all keys (well-mixed bigint). Bits are gathered as 64-bit words, so at most ``bits / 64`` rows meet the driver."""
    a, b = positions(F.col(column), bits)
    return words_to_bits(keys.select(F.explode(F.array(a, b)).alias("slot")), bits)


def words_to_bits(slots: DataFrame, bits: int) -> np.ndarray:
    word = F.shiftright("slot", 6).alias("word")
    one = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    found = slots.groupBy(word).agg(F.bit_or(one).alias("ones")).toArrow()
    out = np.zeros(max(bits // 64, 1), dtype=np.int64)
    out[found["word"].to_numpy()] = found["ones"].to_numpy()
    return out


def hits(bitmap_words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which 64-bit keys may be in the filter."""
    keys = keys.view(np.uint64)
    last = np.uint64(len(bitmap_words) * 64 - 1)
    words = bitmap_words.view(np.uint64)
    out = np.ones(len(keys), dtype=bool)
    for slot in (keys & last, (keys >> np.uint64(32)) & last):
        out &= (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
    return out


def apart(rows: DataFrame, key: Column, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(the rows whose 64-bit ``key`` is certainly not among ``keys``, all others), both with the columns of ``rows``.

    Only the others have to meet ``keys`` in a join, and only key values go through Python: most rows never move.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(keys, column))

    @F.arrow_udf("boolean")
    def may(values: pa.Array) -> pa.Array:
        return pa.array(hits(shared.value, values.to_numpy(zero_copy_only=False)))

    maybe = free_name(rows.columns, "_maybe")
    marked = rows.withColumn(maybe, may(key))
    return marked.filter(~F.col(maybe)).drop(maybe), marked.filter(F.col(maybe)).drop(maybe)
