"""Connected components by alternating large-star and small-star rounds over an edge table.

Nothing is gathered by group: each half round is a partially aggregated minimum by node and a join, which
Spark can split at a hot node. Each round's edges are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import settle


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) of any edges -> (u, v) with v the smallest node of u's component, for all nodes but the smallest."""
    edges = settle(edges.select("u", "v").filter("u <> v"), "components")
    before = None
    while True:
        edges = settle(small_star(large_star(edges)), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return edges
        before = tuple(now)
