"""Connected components of an edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insights.plans.sinks import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung below the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").filter("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are hung below the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node with an edge; ``comp`` is the least node of its component.

    ``edges``: columns u, v.  Each round halves what is not yet a star at least in the
    usual case; a round is a few joins over the edge list, written out, and the rounds
    end when the list no longer changes.
    """
    now = materialize(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        now = materialize(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
