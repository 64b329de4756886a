"""Connected components by alternating large and small stars, every step a shuffle of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.settings import as_table


def large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest one it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of the edges (``a``, ``b``) but that one.

    Loops, repeated edges and either direction are allowed; null ends are left out. Each
    round is written to the shared folder. There are about as many rounds as the
    logarithm of the longest path.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        edges = as_table(small_star(as_table(large_star(edges).distinct(), "large-star")).distinct(), "small-star")
        # All are stars once no centre has one of its own.
        centres = edges.select(F.col("b").alias("a")).distinct()
        if edges.join(centres, "a", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
