"""Connected components by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.shared import drop, store

EDGES = "a long, b long"


def roots(nodes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The smallest node each of `nodes` (sorted, distinct) is connected to by `pairs`, as places in `nodes`."""
    parent = np.arange(len(nodes))
    left, right = pairs
    while len(left):
        low, high = np.minimum(parent[left], parent[right]), np.maximum(parent[left], parent[right])
        apart = low < high
        left, right, low, high = left[apart], right[apart], low[apart], high[apart]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task, some at a time, as (node, smallest node it is connected to by them)."""
    for batch in batches:
        a, b = (batch.column(x).to_numpy() for x in ("a", "b"))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = roots(nodes, at.reshape(2, -1))
        moved = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["a", "b"])


def _large(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest node it knows to its larger neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    moved = both.join(least, "a").where("b > a")
    return moved.select(F.col("b").alias("a"), F.least("a", "least").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest node it knows to its smaller neighbours; edges go from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge (a, b) with a <> b; component is the smallest node reached.

    Every round moves edges towards the smallest nodes and is written to the shared folder, until
    one changes nothing. Nodes with very many edges are aggregated before they are shuffled, and the
    joins that follow are plain ones, which adaptive execution splits.
    """
    at = store(edges.select("a", "b").where("a <> b").mapInArrow(_forest, EDGES).distinct(), "edges")
    before = None
    while True:
        mark = at.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before:
            return at.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                at.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = mark
        after = store(_small(_large(at)), "edges")
        drop(at)
        at = after
