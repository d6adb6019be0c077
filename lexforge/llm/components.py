"""Connected components of a distributed graph, by alternating large-star and small-star steps on DataFrames.

Each round joins edges with the least neighbour of their node, which a partially aggregated groupBy gives, so that a node
with very many edges (AQE splits its side of the join) is no obstacle; the number of rounds grows with the logarithm
of the longest path. Rounds are written to the shared checkpoint folder; only two counters of a round come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

ROUNDS = 60


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the least node reachable) of every node that has an edge to another; nulls are no nodes.

    No edges give no rows; repeated edges, both directions and self-loops are allowed.
    """
    first, second = F.col(a), F.col(b)
    pairs = edges.where(first.isNotNull() & second.isNotNull() & (first != second))
    stars = checkpointed(pairs.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v")).distinct())
    state = fingerprint(stars)
    for _ in range(ROUNDS):
        if state[0] == 0:
            break
        stars = checkpointed(small_star(large_star(stars)))
        before, state = state, fingerprint(stars)
        if state == before:
            break
    else:
        raise RuntimeError(f"no end after {ROUNDS} rounds")
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def fingerprint(stars: DataFrame) -> tuple:
    row = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31)), F.sum(F.xxhash64("v", "u") % (1 << 31))).first()
    return tuple(row)


def large_star(stars: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the least of the node and its neighbours."""
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # a node that is its own least keeps its edges, so those with the most edges needn't be joined
    moved = stars.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least.where("m < u"), "u", "left")
    return moved.select(F.col("w").alias("u"), F.coalesce("m", "u").alias("v")).distinct()


def small_star(stars: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    moved = stars.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
