"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the lowered text are hashed into ``2 ** BUCKET_BITS`` buckets. Document frequencies come from all
training rows. The weights are learned by follow-the-regularised-leader with L1 and L2 penalties on a bounded sample,
about ``sample_per_language`` rows of each language chosen by a hash of the id; a fifth of the sample sets the temperature
instead, which turns the scores into probabilities.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallystrata.llm.text import numbered_columns

BUCKET_BITS, NGRAM = 15, 3
SAMPLE_PER_LANGUAGE = 600
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.005, 0.01
UNDETERMINED = "und"


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray     # [bucket, language]; a last row holds the constants
    temperature: float


def counts_of(value: str) -> np.ndarray:
    """Number of n-grams in each bucket; a space stands before and after the text."""
    points = np.frombuffer(f" {value.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    running = np.zeros(len(points), dtype=np.uint64)
    for n in range(NGRAM):
        running = running[: len(points) - n] * np.uint64(0x100000001B3) + points[n:] + np.uint64(n + 1)
        bucket = (running * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)
        total += np.bincount(bucket.astype(np.int64), minlength=1 << BUCKET_BITS)
    return total


def features(value: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = counts_of(value)
    at = np.flatnonzero(counts)
    weight = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt((weight**2).sum())
    return at, weight / norm if norm else weight


def document_frequencies(rows: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """(documents that have each bucket, documents): each task sums its rows, then a row per bucket is added up."""

    def count(batches):
        total, docs = np.zeros(1 << BUCKET_BITS, dtype=np.int64), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                total += counts_of(value) > 0
                docs += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], docs))], names=["bucket", "n"]
        )

    found = rows.select(text).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((1 << BUCKET_BITS) + 1, dtype=np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out[:-1], int(out[-1])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed form of the regularised leader; coordinates whose gradient sum stays within L1 are zero."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(sample: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    rows = (1 << BUCKET_BITS) + 1
    z, n = np.zeros((rows, classes)), np.zeros((rows, classes))
    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(sample)):
            at, x, label = sample[k]
            at, x = np.append(at, rows - 1), np.append(x, 1.0)
            zs, ns = z[at], n[at]
            w = weights_of(zs, ns)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            after = ns + g * g
            z[at] = zs + g - (np.sqrt(after) - np.sqrt(ns)) / ALPHA * w
            n[at] = after
    return weights_of(z, n).astype(np.float32)


def logits(at: np.ndarray, x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return x @ weights[at] + weights[-1]


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the smallest log loss."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(rows: DataFrame, id_column: str, text: str, label: str, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Learns from ``rows``, whose text and label are not null; None if no label is left."""
    rows = rows.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"), F.col(label).alias("_label"))
    sizes = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    frequency, docs = document_frequencies(rows, "_text")
    idf = np.log((1 + docs) / (1 + frequency)) + 1
    place = F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map([F.lit(x) for k in languages for x in (k, min(1.0, sample_per_language / sizes[k]))])
    idf_shared = rows.sparkSession.sparkContext.broadcast(idf)

    def vectors(batches):
        for batch in batches:
            found = [features(v, idf_shared.value) for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a.tolist() for a, _ in found], pa.list_(pa.int32())), pa.array([x.tolist() for _, x in found], pa.list_(pa.float32())), batch.column(1), batch.column(2)],
                names=["at", "x", "label", "turn"],
            )

    chosen = rows.withColumn("_place", place).filter(F.col("_place") < share[F.col("_label")]).select(
        "_text", "_label", F.pmod(F.xxhash64("_id", F.lit(23)), F.lit(1 << 30)).alias("turn")
    )
    table = chosen.mapInArrow(vectors, "at array<int>, x array<float>, label string, turn bigint").orderBy("turn", "label").toArrow()
    index = {k: i for i, k in enumerate(languages)}
    sample = [
        (np.array(a.values), np.array(x.values, dtype=np.float64), index[k.as_py()])
        for a, x, k in zip(table["at"], table["x"], table["label"])
    ]
    held = len(sample) // 5
    weights = fit(sample[held:], len(languages))
    scores = np.array([logits(a, x, weights) for a, x, _ in sample[:held]]).reshape(held, len(languages))
    return Model(languages, idf, weights, temperature(scores, np.array([k for *_, k in sample[:held]], dtype=int)))


def identify(docs: DataFrame, learn_from: Column, id_column: str = "doc_id", text: str = "text", label: str = "lang", **options) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of the prediction.

    ``learn_from`` picks training rows, of which those without text or label are ignored. A null text or one without a
    letter (Unicode categories L*: neither digits nor fractions or Roman numerals) is ``und`` with score 0; so is every text when there is nothing to learn from. Columns of ``docs`` that have the
    new names are replaced.
    """
    usable = learn_from & F.col(text).isNotNull() & F.col(label).isNotNull()
    model = train(docs.filter(usable), id_column, text, label, **options)
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    # Broadcasts travel by reference to their classes, which executors may not have: plain values only.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    at, columns = docs.columns.index(text), [*docs.columns, "lang_pred", "score"]

    def predict(batches):
        m = Model(*shared.value)
        for batch in batches:
            names, scores = [], []
            for value in batch.column(at):
                value = value.as_py()
                if value is None or not any(map(str.isalpha, value)):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                else:
                    p = softmax(logits(*features(value, m.idf), m.weights) / m.temperature)
                    best = int(p.argmax())
                    names.append(m.languages[best])
                    scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=columns
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return numbered_columns(docs).mapInArrow(predict, f"{schema}, lang_pred string, score double")
