"""Periodic runs of words: seeds of the least overlap that a run must have, extended along the diagonals of their lags.

A run of period q has at least ``max(least, 2 * q)`` words, so the words that repeat q places later form a stretch of at
least ``max(least - q, q)``. Lags fall into classes [1, 8), [8, 16), [16, 32), ... with a guaranteed overlap each; the
k-grams of that length are indexed within their document, and pairs of occurrences whose distance lies in the class are
seeds. Names of all word sequences of 2 ** j words (ranks of pairs of shorter names) make equality exact and let a seed be
extended by binary steps. A table keeps, for each lag, how far its last stretch reached: seeds below it are skipped.

Occurrences at most half a k-gram apart lie within one run of a shorter period, which its own class finds. Such a chain
counts as one occurrence against other chains: each lag between two chains is tried once, so a text of n words has
O(n log n) seeds however often a passage recurs in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAST = 12
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Names of pairs of names, equal exactly where both parts are."""
    return np.unique(first.astype(np.int64) * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


def _names(words: np.ndarray) -> list[np.ndarray]:
    """For j = 0, 1, ... the name of the 2 ** j words from each place, as far as any sequence of that length recurs."""
    table, size = [words], 1
    while 2 * size <= len(words):
        last = table[-1]
        longer = _ranks(last[: len(last) - size], last[size:])
        if int(longer.max()) + 1 == len(longer):
            break
        table.append(longer)
        size *= 2
    return table


def _ahead(table: list[np.ndarray], x: int, y: int) -> int:
    """How many words from x and from y on agree."""
    total = 0
    for j in range(len(table) - 1, -1, -1):
        names = table[j]
        if y + total < len(names) and names[x + total] == names[y + total]:
            total += 1 << j
    return total


def _behind(table: list[np.ndarray], x: int, y: int) -> int:
    """How many words before x and before y agree (x < y)."""
    total = 0
    for j in range(len(table) - 1, -1, -1):
        names, back = table[j], 1 << j
        if x - total - back >= 0 and names[x - total - back] == names[y - total - back]:
            total += back
    return total


def _pairs(names: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of equal k-grams of ``size`` words at a distance in [low, high)."""
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    same = sorted_names[1:] == sorted_names[:-1]
    recurring = np.zeros(len(order), dtype=bool)
    recurring[1:] |= same
    recurring[:-1] |= same
    place, name = order[recurring], sorted_names[recurring]
    if not len(place):
        return place, place
    near = np.zeros(len(place), dtype=bool)
    if low >= size and low > 1:
        near[1:] = (name[1:] == name[:-1]) & (np.diff(place) <= size // 2)
    first = np.flatnonzero(~near)                       # where each chain begins
    last = np.append(first[1:], len(place)) - 1
    found = []
    step = 1
    while step < len(first):
        a, b = np.arange(len(first) - step), np.arange(step, len(first))
        reach = (name[first[a]] == name[first[b]]) & (place[first[b]] - place[last[a]] < high)
        if not reach.any():
            break
        a, b = a[reach], b[reach]
        # every member of the left chain with the head of the right one, and its head with every other member on the right
        left, right = last[a] - first[a] + 1, last[b] - first[b]
        own = np.repeat(first[a], left) + _within(left)
        found.append((place[own], np.repeat(place[first[b]], left) - place[own]))
        other = np.repeat(first[b] + 1, right) + _within(right)
        heads = np.repeat(place[first[a]], right)
        found.append((heads, place[other] - heads))
        step += 1
    if not found:
        return place[:0], place[:0]
    at, lag = (np.concatenate(part) for part in zip(*found))
    fits = (lag >= low) & (lag < high)
    return at[fits], lag[fits]


def _within(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def runs_of(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in a sequence of word numbers, by start and period."""
    n = len(words)
    if n < least or n < 2:
        return []
    seed = max(least // 2, 1)                           # the least of max(least - q, q)
    table = _names(words)
    best: dict[tuple[int, int], int] = {}
    low, high = 1, 1
    while high < max(seed, 2):
        high *= 2
    while low <= n // 2:
        if low == 1:
            # the seeds of the first class: k-grams as long as the largest name below, and the rest of the seed after it
            j = seed.bit_length() - 1
            if j >= len(table):
                break
            size, names = seed, table[j]
            if seed > 1 << j:
                names = _ranks(names[: len(names) - seed + (1 << j)], names[seed - (1 << j) :])
        else:
            j = low.bit_length() - 1
            if j >= len(table):
                break                                   # no sequence of this length recurs
            size, names = low, table[j]
        at, lags = _pairs(names, size, low, high)
        order = np.lexsort((at, lags))
        at, lags = at[order], lags[order]
        # a seed that touches the one before it on its lag belongs to the same stretch
        heads = np.ones(len(at), dtype=bool)
        heads[1:] = (lags[1:] != lags[:-1]) | (np.diff(at) > size)
        reached: dict[int, int] = {}
        for i, lag in zip(at[heads].tolist(), lags[heads].tolist()):
            if i < reached.get(lag, -1):
                continue
            end = i + _ahead(table, i, i + lag)
            start = i - _behind(table, i, i + lag)
            reached[lag] = end
            length = end - start + lag
            if length >= max(least, 2 * lag):
                # a multiple of a run's period spans the same words; the smallest one is its period
                best[start, length] = min(lag, best.get((start, length), lag))
        low, high = high, 2 * high
    return sorted((start, length, lag) for (start, length), lag in best.items())


def _inspect(text: bytes | None, least: int) -> tuple[list[tuple[int, int, int]], bytes]:
    words = (text or b"").split()                       # bytes.split() separates at ASCII white space only
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    runs = runs_of(ids, least)
    if runs:
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return runs, b" ".join(words)


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row.

    Words are the longest stretches without ASCII white space, numbered from 0, and equal when their bytes are. A run is a
    stretch with smallest period q and at least ``max(least, 2 * q)`` words that no neighbouring word extends; ``runs`` has
    them by start, then period. ``collapsed`` holds the words that no run contains after its first period, joined by one
    space. A null or empty text has no word, no run and an empty ``collapsed``. Ids may be null or recur: every row is judged
    by itself. Other columns are not read. No row moves between tasks; memory follows the longest text, whose names take
    8 bytes a word for each doubling of the length at which sequences still recur.
    """
    if least < 2:
        raise ValueError("a run has two words at least")

    def inspect(batches):
        for batch in batches:
            found, kept, sizes = [], [], []
            for value in batch.column(1).cast(pa.binary()):
                raw = value.as_py()
                runs, rest = _inspect(raw, least)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                kept.append(rest)
                sizes.append(len(raw.split()) if raw else 0)
            runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, runs_type), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        inspect, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string"
    )
