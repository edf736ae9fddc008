"""Connected components by alternating star contraction (large star, small star).

Each round is two joins and groupings of the edges; every edge ends at the smallest
node of its component.  A hub's edges are many rows of one key only on the edge side
of a join, whose other side has one row per node, so AQE can split them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of an edge; root is the least node it reaches."""
    now = materialize(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    while True:
        # Large star: every larger neighbour of a node goes to its least neighbour.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            now.select(F.col("v").alias("u"), F.col("u").alias("big"))
            .join(least, "u")
            .select(F.col("big").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        now = materialize(small, "star")
        # Done when the edges are stars: no end of an edge is the start of another
        # and no node has two.
        ends = F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up"))))
        state = now.select(ends.alias("e")).groupBy("e.x").agg(F.sum("e.up").alias("up"), F.count("*").alias("n"))
        if state.where("up > 1 or (up = 1 and n > 1)").isEmpty():
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of edges between 64-bit numbers: (node, least node of its component) without
    the least nodes themselves, at most one edge per node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]
