"""Vectorised reading of Arrow text columns: slices of whole documents, word borders and 64-bit word hashes.

Everything here works on one slice of an Arrow batch, so memory follows the slice (a quarter of a megabyte, or one document if
that is longer; some forty bytes are held for each of its bytes) and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit integers that spreads every input bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


BASE, BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
#: ASCII that is neither letter nor digit; bytes of longer characters count as letters.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base & (2**64 - 1), dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows; null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


class Words(NamedTuple):
    hash: np.ndarray     # of each word, in text order
    first: np.ndarray    # index of the first word of each document, and the number of words at the end
    starts: np.ndarray   # byte offset of each word
    ends: np.ndarray


def words(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> Words:
    """Words are the longest runs without a separator; none crosses a document's border. A-Z count as a-z."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none)
    inside = ~separator[raw]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | border[1:n]
    closes[:-1] &= ~inside[1:] | border[1:n]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUE[LOWER[raw]] * powers(BASE, n), out=sums[1:])
    hashed = mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, n)[starts] + (ends - starts).astype(np.uint64))
    return Words(hashed, np.searchsorted(starts, offsets), starts, ends)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's distinct runs of ``size`` words, sorted within a document, and where each document begins.

    A document with fewer words has its whole sequence as one run; without words it has none.
    """
    n, docs = len(w.hash), len(w.first) - 1
    count = np.diff(w.first)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        step = mix(np.array([k + 1], dtype=np.uint64))[0] | _U(1)
        total[: max(n - k, 0)] += w.hash[k:] * step
    hashed = mix(total)
    bounds = np.zeros(docs + 1, dtype=np.int64)
    parts = []
    for d in range(docs):
        a, b = w.first[d], w.first[d + 1]
        if count[d] >= size:
            own = np.unique(hashed[a : b - size + 1])
        elif count[d]:
            own = short(w.hash[a:b])
        else:
            own = hashed[:0]
        parts.append(own)
        bounds[d + 1] = bounds[d] + len(own)
    return (np.concatenate(parts) if parts else hashed[:0]), bounds


def short(hashes: np.ndarray) -> np.ndarray:
    """One hash for a sequence that is shorter than a shingle."""
    total = _U(len(hashes))
    with np.errstate(over="ignore"):
        for h in hashes:
            total = mix(np.array([total * _U(BASE) + h], dtype=np.uint64))[0]
    return np.array([total], dtype=np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists(values: np.ndarray, bounds: np.ndarray, kind=None) -> pa.ListArray:
    """An Arrow list column; ``bounds`` has one entry more than there are lists."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))


def free_name(taken: list[str], wish: str) -> str:
    """``wish``, with underscores behind it until no column has that name, whatever its case."""
    lowered = {name.lower() for name in taken}
    while wish.lower() in lowered:
        wish += "_"
    return wish


def numbered_columns(docs):
    """``docs`` with columns named by position, as Arrow functions take no names with dots."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
