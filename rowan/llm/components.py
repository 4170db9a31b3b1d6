"""Connected components of a graph held as edges between longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowan.sources.scratch import written


def _stars(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node, and the node, under the least of them all (large star)."""
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_stars(edges: DataFrame) -> DataFrame:
    """edges point down (u > v). Every smaller neighbour of a node, and the node, under the least."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """edges: columns a, b, both ways or one. Gives node and root, the least node it reaches, for every
    node of an edge between two different nodes.

    Large and small stars alternate until each node hangs under its root, in a number of rounds that
    grows with the logarithm of the nodes. Each round's edges are written to the shared folder, so that
    neither lineage nor memory grows; hub nodes only meet joins that can be split.
    """
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, before = written(down.distinct()), None
    while True:
        count, total, sums = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if (count, total, sums) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = (count, total, sums)
        large = written(_stars(now.select(F.col("u").alias("a"), F.col("v").alias("b"))).distinct())
        now = written(_small_stars(large).distinct())
