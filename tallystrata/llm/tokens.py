"""Token counts by linear longest-match automaton.

The vocabulary's trie has failure links that tell where to go on when no piece continues, and the number of pieces that
are popped on the way. Both are computed once, so each character of a word is read once and no piece is built.
"""

from __future__ import annotations

import base64
from collections import deque
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Words whose count a task remembers; beyond, it starts anew.
REMEMBERED = 1 << 17


class Automaton(NamedTuple):
    step: list[dict[int, int]]  # transitions of each node
    fail: list[int]             # next node when there is none; -1: no way to go on
    popped: list[int]           # pieces that the failure link completes
    rest: int                   # node from which a word goes on after its first piece


def build(first: set[bytes], later: set[bytes]) -> Automaton:
    """``first``: pieces that begin a word, ``later``: pieces that go on; both may be the same set."""
    step, piece = [{}], [False]

    def add(root, words):
        for word in words:
            at = root
            for c in word:
                at = step[at].setdefault(c, len(step))
                if at == len(step):
                    step.append({})
                    piece.append(False)
            if word:
                piece[at] = True

    add(0, first)
    rest = 0
    if later != first:
        rest = len(step)
        step.append({})
        piece.append(False)
        add(rest, later)
    fail, popped = [-1] * len(step), [0] * len(step)
    queue = deque((root, c, node) for root in {0, rest} for c, node in step[root].items())
    while queue:
        parent, c, node = queue.popleft()
        if piece[node]:
            fail[node], popped[node] = rest, 1
        else:
            at, n = fail[parent], popped[parent]
            while at >= 0 and c not in step[at]:
                n += popped[at]
                at = fail[at]
            if at >= 0:
                fail[node], popped[node] = step[at][c], n
        queue.extend((node, k, x) for k, x in step[node].items())
    return Automaton(step, fail, popped, rest)


def count(word: bytes, a: Automaton) -> int:
    """Pieces of a word by greedy longest match; 1 (the unknown piece) if it cannot be cut, 0 if it is empty."""
    step, fail, popped, _ = a
    at = n = 0
    for c in word:
        while c not in step[at]:
            n += popped[at]
            at = fail[at]
            if at < 0:
                return 1
        at = step[at][c]
    while at != a.rest and at != 0:
        n += popped[at]
        at = fail[at]
        if at < 0:
            return 1
    return n


def byte_vocabulary(path: str = DEFAULT_VOCABULARY) -> set[bytes]:
    """Pieces of a rank file: base64 and number on each line. It is read on the driver; the file's size bounds it."""
    with open(path, "rb") as lines:
        return {base64.b64decode(line.split()[0]) for line in lines if line.strip()}


def token_counts(
    docs: DataFrame, first: set[bytes], later: set[bytes] | None = None, prefix: bytes = b"", id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_tokens`` for every row; null text counts as empty.

    Words are runs without ASCII white space, as UTF-8 bytes with ``prefix`` before them, cut greedily into the longest
    pieces: the first one from ``first``, the others from ``later`` (default: the same). A word that cannot be cut is one token.
    """
    shared = docs.sparkSession.sparkContext.broadcast((first, first if later is None else later))
    id_type = docs.schema[id_column].dataType.simpleString()

    def read(batches):
        automaton = build(*shared.value)
        known: dict[bytes, int] = {}
        for batch in batches:
            n_words, n_tokens = [], []
            for value in batch.column(1).cast(pa.binary()):
                words = value.as_py().split() if value.is_valid else []
                total = 0
                for word in words:
                    n = known.get(word)
                    if n is None:
                        n = count(prefix + word, automaton)
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = n
                    total += n
                n_words.append(len(words))
                n_tokens.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"]
            )

    return docs.select(F.col(id_column).alias("doc_id"), text).mapInArrow(read, f"doc_id {id_type}, n_words bigint, n_tokens bigint")
