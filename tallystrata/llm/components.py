"""Connected components of undirected graphs given as pairs, without gathering a component anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystrata.sources.scratch import stored


def stars(graph: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same components with fewer links: each vertex but the smallest of its component, linked with that one."""
    values, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    offset = graph.astype(np.int64) * len(values)
    left, right = codes[: len(u)] + offset, codes[len(u) :] + offset
    label = np.arange(len(values) * (int(graph.max(initial=0)) + 1))
    while (label[left] != label[right]).any():
        least = np.minimum(label[left], label[right])
        for ends in (left, right):
            np.minimum.at(label, label[ends], least)
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(label)))
    size = max(len(values), 1)
    return moved // size, values[moved % size], values[label[moved] % size]


def _contracted(links: DataFrame) -> DataFrame:
    """Replaces the links of each Arrow batch by stars, which need fewer rounds; no shuffle."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("u").type
            graph, u, v = stars(*(column.to_numpy(zero_copy_only=False) for column in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(graph, pa.int32()), pa.array(u, kind), pa.array(v, kind)], names=["graph", "u", "v"])

    return links.select("graph", "u", "v").mapInArrow(contract, f"graph int, u {links.schema['u'].dataType.simpleString()}, v {links.schema['v'].dataType.simpleString()}")


def components(*graphs: DataFrame) -> list[DataFrame]:
    """For each graph (pairs ``a, b``) ``id, label``: the smallest id that each vertex reaches.

    Ids are values of one type, not null. The graphs are solved side by side, so that they share the rounds.

    Alternates two contractions until nothing changes: every vertex links its larger neighbours, and then its smaller
    ones, to the smallest vertex that it sees. Both only aggregate per vertex, so hubs are combined before the shuffle,
    and the rounds grow with the logarithm of the longest path. Before each round the tasks contract what they hold.
    """
    pairs = None
    for k, edges in enumerate(graphs):
        part = edges.filter("a != b").select(F.lit(k).alias("graph"), F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        pairs = part if pairs is None else pairs.unionByName(part)
    links = stored(_contracted(pairs), "links")
    while True:
        both = links.unionByName(links.select("graph", F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("graph", "u").agg(F.min("v").alias("m")).select("graph", "u", F.least("u", "m").alias("m"))
        down = both.join(least, ["graph", "u"]).filter("v > u").select("graph", F.col("v").alias("u"), F.col("m").alias("v"))
        smallest = down.groupBy("graph", "u").agg(F.min("v").alias("m"))
        merged = down.join(smallest, ["graph", "u"]).select(
            "graph", F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        links = stored(merged.distinct(), "links")
        # A forest of stars in which no centre is below another vertex is final.
        # Every link has u > v, so it is one when each u occurs once and no v occurs as a u.
        most = links.groupBy("graph", "u").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        below = links.select("graph", F.col("u").alias("v"))
        if most is None or (most == 1 and links.join(below, ["graph", "v"], "left_semi").isEmpty()):
            break
        links = stored(_contracted(links), "links")
    labels = links.select("graph", F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        links.select("graph", F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    )
    return [labels.filter(F.col("graph") == k).drop("graph") for k in range(len(graphs))]
