"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.session import materialize


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for each node of an edge; a component is named by its least node.

    Each round hangs the greater neighbours of every node on its least neighbour, then
    the smaller ones, until only stars are left; rounds grow with the logarithm of the
    longest path. Every round is stored, so a lost executor costs no more than a round.
    """
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    pairs = materialize(pairs.where("u <> v").distinct(), "edges")
    while not _stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        pairs = materialize(small.where("u <> v").distinct(), "small-star")
    named = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return materialize(named.unionByName(roots), "components")


def _stars(pairs: DataFrame) -> bool:
    """Whether each node hangs on one other at most, and none on one that hangs itself."""
    hangs = pairs.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("hangs"))
    held = pairs.select(F.col("v").alias("node")).distinct().withColumn("holds", F.lit(1))
    ends = hangs.withColumn("holds", F.lit(0)).unionByName(held.withColumn("hangs", F.lit(0)))
    ends = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return ends.where("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty()
