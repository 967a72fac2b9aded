"""Connected components by alternating large-star and small-star steps.

Each step rewires every edge towards the least neighbour; the number of
rounds grows with the logarithm of the longest path, and the number of edges
never grows. Every round is one written table, so a lost executor repeats at
most one round and no edge passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.store import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link every larger neighbour of u to the least of u and its
    neighbours. Small star: the same over the smaller neighbours and u itself.
    The least neighbour comes from an aggregate with map-side combine and a
    join, so a node of very many neighbours is never one task's group."""
    flip = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))  # a < b
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(flip)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").filter("v > u").select("v", "m")
    else:
        least = flip.groupBy("u").agg(F.min("v").alias("m"))
        out = flip.join(least, "u").select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m"))
    return out.filter("v != m").select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b")).distinct()


def connected_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every end of ``links`` (columns a, b); root is the least
    node of the component. Self links are ignored."""
    edges = materialize(links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "components-0")
    mark, rounds = None, 0
    while True:
        rounds += 1
        edges = materialize(_star(_star(edges, True), False), f"components-{rounds}")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (now["n"], now["h"]) == mark or now["n"] == 0:
            break
        mark = (now["n"], now["h"])
    # at the fixed point every edge points from a member to its root
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
