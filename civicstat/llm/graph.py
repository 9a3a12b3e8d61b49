"""Connected components by alternating star contractions, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node reachable.

    Each round makes every node's larger neighbours point to its smallest neighbour, then its
    smaller ones; it ends when the edges stay the same, that is when they are stars. The number
    of rounds grows with the logarithm of the longest path. Rounds are written to the shared
    folder. Groups are only aggregated to a minimum, never gathered.
    """
    both = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stage(both, name)
    seen = _sum(now)
    while True:
        now = stage(_small_star(_large_star(now)), name)
        if (state := _sum(now)) == seen:
            break
        seen = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node goes to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, go to the smallest of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
