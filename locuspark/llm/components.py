"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import cut_lineage


def _with_min(pairs: DataFrame) -> DataFrame:
    """(u, v) pairs plus ``m``, the smallest of u and all its v; the minimum is pre-aggregated per task."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(low, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _with_min(down)
    return stars.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        stars.select("u", F.col("m").alias("v"))).where("u != v")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` -> ``(node, component)``: the smallest node id reachable from each node.

    Self-loops and repeated edges are allowed; nodes without an edge to another
    node do not appear.  The number of rounds grows with the logarithm of the
    component size; each round's edges are written to the checkpoint folder.
    """
    state = cut_lineage(edges.where("u != v").select("u", "v").distinct())
    mark = None
    while True:
        state = cut_lineage(_small_star(_large_star(state).distinct()).distinct())
        now = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                state.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        mark = tuple(now)
