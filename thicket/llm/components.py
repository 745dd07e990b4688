"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges a-b, and the least node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return nodes, nodes[label]


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """node, component (its least node) for each node of an edge, by alternating large and small stars.

    Minima are aggregated before the shuffle, and joins on a node with many neighbours are
    equi-joins that adaptive execution may split; no neighbour list is collected.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u > v").distinct()
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*")
        e = checkpoint(small.filter("u > v").distinct())
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
