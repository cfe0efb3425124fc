"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.runtime import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for each node of ``edges`` (``a``, ``b``, any order).

    Large and small stars alternate until the edges are stars around the roots, about log2 of the longest
    path many rounds. Every round is two aggregates on the map side and a join with one row per node, so a
    node that most edges end in is never gathered. Each round is a written table.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    pairs = materialize(pairs, "stars")
    seen = None
    while True:
        pairs = materialize(_small_star(_large_star(pairs)), "stars")
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is joined to the smallest of the node and its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, is joined to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    others = pairs.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
