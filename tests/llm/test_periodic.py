"""Periodic runs against a search of every lag."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tallystrata.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """Every lag from 1 up, each stretch of words that recur at that lag; a multiple of a period spans the same words."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least, 2 * q):
                found.setdefault((start, length), q)
            i += 1
    return sorted((s, length, q) for (s, length), q in found.items())


def words_of(text):
    return WORD.findall(text or "")


def rewritten(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def sequences(rng):
    """Random, repetitive, nested, Fibonacci and Thue-Morse words."""
    letters = rng.choice((1, 2, 3, 40))
    yield [rng.randrange(letters) for _ in range(rng.randrange(120))]
    pieces = []
    while len(pieces) < 80:
        pieces += [rng.randrange(letters + 1) for _ in range(rng.randrange(1, 25))] * rng.randrange(1, 6)
    yield pieces
    yield ([0] * rng.randrange(1, 40) + [1] + [0] * rng.randrange(40)) * rng.randrange(1, 4) + [0] * rng.randrange(20)
    u, v = [0], [1]
    for _ in range(rng.randrange(1, 9)):
        u, v = u + v, u
    yield u
    morse = [0]
    for _ in range(rng.randrange(1, 8)):
        morse += [1 - x for x in morse]
    yield morse


@pytest.mark.parametrize("least", [2, 5, 8, 12, 17])
def test_every_run_is_found(least):
    rng = random.Random(least)
    for _ in range(60):
        for words in sequences(rng):
            assert periodic.runs_of(np.array(words, dtype=np.int64), least) == brute(words, least)


def test_work_does_not_grow_with_the_square_of_repetitions():
    n = 100_000
    assert periodic.runs_of(np.zeros(n, dtype=np.int64)) == [(0, n, 1)]
    lines = np.tile(np.arange(20), n // 20)
    assert periodic.runs_of(lines) == [(0, n, 20)]


def texts():
    rng = random.Random(4)
    some = [f"w{k}" for k in range(60)]
    made = [" ".join(rng.choices(some, k=rng.randint(1, 90))) for _ in range(60)]
    made += [" \n".join(rng.choices(some, k=rng.randint(1, 9)) * rng.randint(2, 9)) for _ in range(60)]
    made += [None, "", " \t\n ", "a", "A a " * 20, "é x é x " * 8, "ab" * 40, "z " * 3_000, " ".join(map(str, range(3_000))) + " q" * 50]
    return list(enumerate(made)) + [(5, "again " * 13), (None, "null id " * 9), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "extra", 1) for i, t in texts()], "doc_id long, text string, runs string, n_words int")


def test_runs_and_collapsed_texts(docs):
    expected = []
    for i, t in texts():
        words = words_of(t)
        runs = brute(words) if len(words) < 3_000 else periodic.runs_of(np.unique(words, return_inverse=True)[1])
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        expected.append((i, len(words), runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
    found = periodic.periodic_runs(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert sorted(map(repr, [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()])) == sorted(map(repr, expected))


def test_digests_of_the_query(docs, tmp_path, spark):
    rows = []
    for i, t in texts():
        words = rewritten(i, words_of(t))
        runs = brute(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        rows.append((
            i, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
        ))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, rows))
    assert any(len(words_of(t)) and i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, t in texts())


def test_no_documents(spark, docs):
    assert periodic.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, least=1)
