"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.sources.writers import staged

EDGES_A_TASK = 10_000


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select("v", "u"))


def _large_star(edges: DataFrame, near: DataFrame, parts: int) -> DataFrame:
    """The larger neighbours of a node move to its smallest neighbour. Edges may repeat."""
    least = near.select("u", F.least("low", "u").alias("m"))
    moved = _neighbours(edges).where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return staged(moved.coalesce(parts), "star-edges")


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), "star-least")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
    return staged(moved.union(least.select("u", F.col("m").alias("v"))).distinct().coalesce(parts), "star-edges")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node of ``edges`` (a, b).

    Edges stay in tables; the driver sees their number at the start, which no step exceeds and which sets the
    number of tasks, and whether a node is left that has a smaller neighbour and others. Without such nodes all
    trees are stars around their smallest node. Self-loops and edges with a null end are ignored. The
    steps needed grow with the logarithm of the longest path.
    """
    u, v = F.greatest("a", "b"), F.least("a", "b")
    now = staged(edges.where("a <> b").select(u.alias("u"), v.alias("v")).distinct(), "star-edges")
    parts = max(1, -(-now.count() // EDGES_A_TASK))
    while True:
        near = _neighbours(now).groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n"))
        near = staged(near.coalesce(parts), "star-near")
        if near.where("low < u AND n > 1").isEmpty():
            return near.select(F.col("u").alias("node"), F.least("low", "u").alias("component"))
        now = _small_star(_large_star(now, near, parts), parts)
