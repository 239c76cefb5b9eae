"""Connected components: over an edge table in alternating star steps, and of edges in hand."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Nodes of an edge table (a, b: long) with the smallest node each can reach.

    Large-star links every larger neighbour of a node to the node's smallest
    neighbour; small-star does so with the smaller ones. Each round is written
    to the shared folder, so lineage stays short and a lost executor costs one
    round at most. Edges shrink to a star around each component's smallest
    node. Self loops, repeated edges and nulls are ignored. Returns (node,
    component) for nodes that have an edge; empty for no edges.
    """
    clean = edges.where("a is not null and b is not null and a <> b")
    current = Written(clean.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = current.df.unionByName(current.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        after = Written(small.where("u <> v").distinct())
        now = after.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        current.drop()
        current = after
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = current.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def forest(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest (node, its smallest reachable) of edges over 0..n-1."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, u, label[v])
        np.minimum.at(label, v, label[u])
        label = label[label]
        if (label == before).all():
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]
