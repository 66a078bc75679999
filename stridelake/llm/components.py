"""Connected components of an edge table, by star contraction.

Each round hangs every node's larger neighbours on its least neighbour
(large star) and then its smaller ones (small star), until only stars are
left. Rounds grow with the logarithm of the longest chain. Only aggregates and
joins on node ids run; a node with very many neighbours is one skewed join key,
which adaptive execution splits. Rounds are cut with checkpoint() in the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root


def least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = least_neighbour(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    least = least_neighbour(edges)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``u, v`` (long) -> ``node, root``: the least node reachable, for every
    node that has an edge to a smaller one. Self loops and repeats are allowed."""
    checkpoint_root(edges.sparkSession)
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .distinct().checkpoint()
    seen = fingerprint(now)
    for _ in range(max_rounds):
        now = small_star(large_star(now)).checkpoint()
        after = fingerprint(now)
        if after == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
