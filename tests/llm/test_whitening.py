"""Whitening against exact integers and a plain eigendecomposition."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tallystrata.llm import whitening

SHAPE = "vec_id long, embedding array<float>, n int, x string"


def vectors(seed=3, rows=400, d=7):
    rng = np.random.default_rng(seed)
    base = (rng.normal(size=(rows, d)) @ rng.normal(size=(d, d)) + 3).astype(np.float32)
    made = [(i, [float(v) for v in row]) for i, row in enumerate(base)]
    nan, inf = float("nan"), float("inf")
    # copies of one vector, ties by rounding, and what is left out
    made += [(1000 + i, made[0][1]) for i in range(300)] + [(None, made[1][1]), (7, made[2][1])]
    made += [(2000, None), (2001, [1.0] * (d - 1) + [None]), (2002, [nan] + [1.0] * (d - 1)), (2003, [1.0] * (d - 1) + [-inf]),
             (2004, []), (2005, [1.0] * (d + 1)), (2006, [-0.0] * d)]
    random.Random(1).shuffle(made)
    return made


def usable(rows, d):
    ok = lambda v: v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)
    return [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if ok(v)]


def test_components(spark):
    rows, d = vectors(), 7
    kept = usable(rows, d)
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    u = [[n * v - s for v, s in zip(x, sums)] for x in fit]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in u), n**3)) for j in range(d)] for i in range(d)])
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]

    found = whitening.whiten(spark.createDataFrame([(i, v, 1, "") for i, v in rows], SHAPE)).collect()
    assert len(found) == 4 * len(kept) and {r.component for r in found} == {1, 2, 3, 4}
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    want = {}
    for i, x in kept:
        want.setdefault((i, sum((n * v - s) ** 2 for v, s in zip(x, sums))), x)
    assert set(by_row) == set(want)
    signs = {}
    for key, x in want.items():
        for k in range(1, 5):
            for r in by_row[key][k]:
                plain = float((np.array(x) - np.array(sums) / n) @ basis[:, k - 1] / math.sqrt(values[k - 1]))
                signs.setdefault(k, 1 if plain * r.whitened > 0 else -1)
                assert r.whitened == pytest.approx(signs[k] * plain, rel=1e-9, abs=1e-9)
                assert r.n == n and r.explained == pytest.approx(values[k - 1] / np.trace(cov), rel=1e-9)
    error = {r.identity_error for r in found}
    assert len(error) == 1 and error.pop() < 1e-9


def test_covariance_is_exact_at_a_large_offset():
    """Floating-point products would lose all digits here."""
    x = np.array([[2**40 + k % 3, 2**40 - k % 5] for k in range(50)])
    pairs = whitening._squares(x - 2**40)
    assert pairs == [sum((k % 3) ** 2 for k in range(50)), sum((k % 3 - k % 5) ** 2 for k in range(50)), sum((k % 5) ** 2 for k in range(50))]
    huge = np.array([[2**62, -(2**62)], [2**62, 2**62]])
    assert whitening._squares(huge) == [2 * 2**124, 4 * 2**124, 2 * 2**124]
    assert whitening._sums(huge) == [2, 2**63, 0]


def test_constant_and_dependent_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0], 0, "") for i in range(20)]
    found = whitening.whiten(spark.createDataFrame(rows, SHAPE)).collect()
    assert {r.component for r in found} == {1, 2, 3} and len(found) == 60
    assert all((r.whitened is None) == (r.component > 1) for r in found)
    assert {r.explained for r in found if r.component == 1} == {1.0} and found[0].identity_error < 1e-9
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, [1.0, 2.0], 0, "")], SHAPE)).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {
        (i, k, 1, 0, None, None, 0.0) for i in (1, 2) for k in (1, 2)}


def test_nothing_to_fit(spark):
    empty = whitening.whiten(spark.createDataFrame([], SHAPE))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(spark.createDataFrame([(1, None, 0, ""), (2, [], 0, ""), (3, [float("nan")], 0, "")], SHAPE)).collect() == []


def test_dimensions_are_the_most_frequent_ones(spark):
    rows = [(i, [float(i), 1.0], 0, "") for i in range(5)] + [(9, [1.0, 2.0, 3.0], 0, "")]
    frame = spark.createDataFrame(rows, SHAPE)
    assert {r.vec_id for r in whitening.whiten(frame).collect()} == set(range(5))
    assert {r.vec_id for r in whitening.whiten(frame, dimensions=3).collect()} == {9}
