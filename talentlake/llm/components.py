"""Connected components of an edge table, by alternating large and small stars.

Every step is joins and aggregates over tables in the shared folder, so it survives lost
executors and its lineage stays short; the driver sees two numbers per round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.workspace import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour, or itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("least")), "least")
    across = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return across.union(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) of every node of ``edges`` (two long columns); a component is known by
    its least node. Edges from a node to itself, repeated and reversed ones do no harm."""
    a, b = edges.columns

    def settled(df: DataFrame) -> tuple[DataFrame, tuple]:
        kept = stored(df.where(F.col("a") != F.col("b")).distinct(), "edges")
        mark = F.xxhash64("a", "b")
        return kept, tuple(kept.agg(F.count("*"), F.sum(mark % 1_000_003), F.sum(F.shiftright(mark, 32))).first())

    nodes = edges.select(F.explode(F.array(a, b)).alias("node"))
    current, state = settled(edges.select(F.col(a).alias("a"), F.col(b).alias("b")))
    for _ in range(rounds):
        if not state[0]:
            break
        current, after = settled(_small_star(_large_star(current)))
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # Now every node but a component's least is linked to that one.
    nodes = nodes.distinct()
    found = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def local_roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least position reachable from each of ``size`` positions over the links given."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        after = root.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after
