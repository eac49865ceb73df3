"""Whitening of embeddings with a covariance found by polarisation.

No product of two dimensions is ever aggregated. The sums of squares of every dimension and of the sum of every two
dimensions are, and ``2 * cov(a, b) = var(a + b) - var(a) - var(b)`` gives the rest. All sums are of integers: entries are
counted in steps of 1 / ``scale``, squares are taken around a whole number next to the mean, and the remaining fraction is
settled in exact integers once the sums are known. Tasks add up their own rows, so d * (d + 1) / 2 numbers leave each of
them, whatever its number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallystrata.sources.scratch import stored

#: Entries of a matrix that a task works on at a time.
CELLS = 1 << 20


@dataclass(frozen=True)
class Fit:
    """n, the sums S, eigenvalues (falling) and eigenvectors (columns) of the covariance, and its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def rank(self) -> int:
        """Eigenvalues that stand out from rounding."""
        return int((self.values > max(self.trace, 0.0) * len(self.values) * np.finfo(float).eps).sum())


def usable(vector: Column, dimensions: int) -> Column:
    """Whether a vector has ``dimensions`` entries, none of them null, NaN or infinite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dimensions) & ~bad, F.lit(False))


def width(vectors: DataFrame, column: str) -> int:
    """The number of entries that most vectors have (of equally frequent ones the largest); 0 without vectors."""
    counted = vectors.filter(F.size(column) > 0).groupBy(F.size(column).alias("d")).agg(F.count("*").alias("rows"))
    best = counted.orderBy(F.desc("rows"), F.desc("d")).first()
    return best.d if best else 0


def _matrices(column: pa.Array, dimensions: int):
    """Slices of an Arrow list column as integer matrices."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    step = max(1, CELLS // dimensions)
    for i in range(0, len(flat), step):
        yield flat[i : i + step]


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _sums(x: np.ndarray) -> list[int]:
    """Number of rows, and the sum of each dimension. Python's integers take over where 64 bits might not hold a sum."""
    return [len(x), *x.sum(axis=0, dtype=object if _largest(x) * len(x) >= 1 << 63 else None).tolist()]


def _squares(x: np.ndarray) -> list[int]:
    """For each pair i <= j the sum over rows of x_i squared (i = j) or of (x_i + x_j) squared."""
    d = x.shape[1]
    x = x.astype(object) if 4 * _largest(x) ** 2 * len(x) >= 1 << 63 else x
    out: list[int] = []
    for i in range(d):
        own = x[:, i : i + 1]
        sums = x[:, i:] + own
        sums[:, 0] = x[:, i]
        out.extend((sums * sums).sum(axis=0).tolist())
    return out


def _summed(rows: DataFrame, partial, name: str) -> list[int]:
    """Adds up the lists of integers that ``partial`` makes of a task's batches."""

    def run(batches):
        total = None
        for batch in batches:
            for found in partial(batch):
                total = found if total is None else [a + b for a, b in zip(total, found)]
        if total is not None:
            at = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array([str(v) for v in total])], names=["at", name])

    parts = rows.mapInArrow(run, f"at int, {name} string")
    # one row for each dimension or pair of dimensions
    summed = parts.groupBy("at").agg(F.sum(F.col(name).cast("decimal(38,0)")).alias(name)).orderBy("at").collect()
    return [int(row[name]) for row in summed]


def fit(distinct: DataFrame, dimensions: int) -> Fit | None:
    """Fits on the rows of ``x`` (array<bigint>), each of which counts; None without rows."""
    sums = _summed(distinct.select("x"), lambda batch: map(_sums, _matrices(batch.column(0), dimensions)), "sums")
    if not sums:
        return None
    n, sums = sums[0], sums[1:]
    centre = np.array([s // n for s in sums], dtype=np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]    # of n * x - S, 0 <= rest < n
    squares = iter(_summed(
        distinct.select("x"), lambda batch: (_squares(m - centre) for m in _matrices(batch.column(0), dimensions)), "squares"
    ))
    # variance of y = x_i or x_i + x_j, over its centred whole numbers u with sum r: (n * sum(u * u) - r * r) / n / n
    raw = np.empty((dimensions, dimensions), dtype=object)
    for i in range(dimensions):
        for j in range(i, dimensions):
            r = rest[i] if i == j else rest[i] + rest[j]
            raw[i, j] = n * next(squares) - r * r
    cov = np.empty((dimensions, dimensions))
    for i in range(dimensions):
        cov[i, i] = Fraction(raw[i, i], n * n)
        for j in range(i):
            cov[i, j] = cov[j, i] = Fraction(raw[j, i] - raw[i, i] - raw[j, j], 2 * n * n)
    values, vectors = np.linalg.eigh(cov)
    trace = float(Fraction(sum(raw[i, i] for i in range(dimensions)), n * n))
    return Fit(n, sums, np.maximum(values[::-1], 0.0), vectors[:, ::-1], trace)


def _projected(model: Fit, components: int):
    """Function of a matrix: n * x - S (exact integers) and the whitened components, as far as the rank goes."""
    n, k = model.n, min(components, model.rank)
    sums = np.array(model.sums, dtype=object)
    most = max(abs(s) for s in model.sums)
    scaled = model.vectors[:, :k] / np.sqrt(model.values[:k])

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        largest = n * _largest(x) + most
        if len(sums) * largest * largest < 1 << 63:
            centred = n * x - sums.astype(np.int64)
        else:
            centred = x.astype(object) * n - sums
        return centred, (centred / n).astype(float) @ scaled

    return project


def identity_error(distinct: DataFrame, model: Fit, components: int, dimensions: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured on the whitened vectors."""
    project, k = _projected(model, components), min(components, model.rank)
    if not k:
        return 0.0

    def partial(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            for m in _matrices(batch.column(0), dimensions):
                white = project(m)[1]
                total[0] += white.sum(axis=0)
                total[1:] += white.T @ white
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "part"])

    found = distinct.select("x").mapInArrow(partial, "at int, part double").groupBy("at").agg(F.sum("part").alias("part"))
    total = np.array([row.part for row in found.orderBy("at").collect()]).reshape(k + 1, k) / model.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256,
    dimensions: int | None = None,
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row for each usable vector and component.

    Vectors that are null, or hold a null, NaN or infinite entry, are left out, and so are empty ones and those that have not
    ``dimensions`` entries (None: as many as most vectors have). Entries become ``floor(scale * c)``. Each different vector counts once in the fit, so repeated rows change nothing, and every one of them is
    returned; ids may be null or recur. Components are numbered from 1 by falling eigenvalue (as many as there are
    dimensions at most), with the same sign for all rows. A component without variance has a null ``whitened`` and takes no
    part in ``identity_error``; ``explained`` is null where nothing varies. ``deviation`` is exact, and the query stops
    where it exceeds 64 bits, or a sum of squares 38 digits. Other columns are not read; without usable vectors there are no rows.
    """
    plain = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector).alias("v"))
    d = width(plain, "v") if dimensions is None else dimensions
    rows = plain.filter(usable(F.col("v"), d)).select("vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * scale)).alias("x"))
    kind = vectors.schema[id_column].dataType.simpleString()
    shape = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    # A vector that many rows share leaves one row per task.
    distinct = stored(rows.select("x").distinct(), "vectors") if d else None
    model = fit(distinct, d) if d else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], shape)
    error, project = identity_error(distinct, model, components, d), _projected(model, components)
    shown, rank, n = min(components, d), min(components, model.rank), model.n
    explained = [float(v) / model.trace if model.trace > 0 else None for v in model.values[:shown]]

    def score(batches):
        for batch in batches:
            begin = 0
            for m in _matrices(batch.column(1), d):
                centred, white = project(m)
                full = np.full((len(m), shown), np.nan)
                full[:, :rank] = white
                deviation = [int(v) for v in (centred * centred).sum(axis=1)]
                at = np.repeat(np.arange(begin, begin + len(m)), shown)
                size = len(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, shown + 1), len(m)), pa.int32()),
                     pa.array(np.full(size, n)), pa.array([v for v in deviation for _ in range(shown)], pa.int64()),
                     pa.array(full.ravel(), mask=np.isnan(full.ravel())), pa.array(explained * len(m), pa.float64()),
                     pa.array(np.full(size, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )
                begin += len(m)

    return rows.mapInArrow(score, shape)
