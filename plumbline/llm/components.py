"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources.staging import Staging


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over some edges: each node but the roots, with the smallest node that it reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(ends[: len(a)].tolist(), ends[len(a) :].tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.fromiter((root(x) for x in range(len(nodes))), np.int64, len(nodes))
    moved = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[moved], nodes[roots[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task become a forest, a batch at a time, so memory follows the nodes of the task."""
    a = b = np.empty(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy()])
        b = np.concatenate([b, batch.column(1).to_numpy()])
        a, b = forest(a, b)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def components(links: DataFrame, staging: Staging) -> DataFrame:
    """``node, component`` (the smallest node of its component) of all linked nodes that are not themselves smallest.

    ``links`` has long columns ``a, b``. Each task first reduces its links to a forest by
    union-find; large-star and small-star steps over the rest then end in stars. Rounds grow
    with the logarithm of the longest path; nothing but a count reaches the driver.
    """
    edges = links.select("a", "b").where("a <> b").mapInArrow(_contract, "a long, b long")
    edges = staging.put(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(nearest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staging.put(large, "large-star")
        nearest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(nearest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staging.put(small.union(nearest.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    hashes = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashes)).first())
