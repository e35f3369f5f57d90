"""Connected components of an edge table, in a few rounds of aggregates and joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import store


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge that is not the least of its component.

    Alternates the published large-star and small-star steps until every edge points at a root.
    Neighbour lists are never collected: a step is a minimum per node and a join back to the
    edges, so a node with very many edges is combined on the map side and split by skew handling.
    """
    now = store(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
        "edges",
    )
    state = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
        now = store(small.filter("u <> v").distinct(), "small")
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = found


def find_roots(parent: np.ndarray) -> None:
    """Point every entry at the root of its tree, in place."""
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return
        parent[:] = up


def unite(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Merge the trees of all pairs; the least index of a tree is its root."""
    while True:
        find_roots(parent)
        a, b = parent[left], parent[right]
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
