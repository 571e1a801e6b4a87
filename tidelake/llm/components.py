"""Connected components over edges of longs, by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.rows import written


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An edge from every node to the smallest node that the given edges reach from it."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        low = np.minimum(least[left], least[right])
        # The roots of both ends learn the smaller one, then every node follows its root.
        np.minimum.at(least, least[left], low)
        np.minimum.at(least, least[right], low)
        least = least[least]
        if (before == least).all():
            break
    moved = least != np.arange(len(nodes))
    return nodes[moved], nodes[least[moved]]


def min_reachable(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from every node of the edges (a, b).

    Large and small stars alternate until a round changes nothing.  Each is one grouped minimum
    and one join; a node of many edges is folded ahead of the shuffle, and its rows in the
    join are split by adaptive execution.  Every round is written to the shared folder.
    """
    stars = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v")).distinct()
    mark = None
    for _ in range(most_rounds):
        # Large star: every node hands its smallest neighbour, itself included, to its larger ones.
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every node hands its smallest neighbour to its smaller ones and itself.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.unionAll(low.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct(), "stars")
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark or now[0] == 0:
            return stars.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        mark = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
