"""Connected components by alternating large and small stars.

Each round rewrites the edges with two group-bys and joins, cut by a table in
the shared folder; the number of rounds grows with the logarithm of a
component's diameter, and nothing is collected. Labels are the smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import materialise


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an undirected edge table; an empty table gives no rows."""
    e = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter("u <> v").distinct(), "cc-edges")
    while not _stars(e):
        # Large star: every greater neighbour points to the smallest neighbour.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))
        # Small star: a node's smaller neighbours and itself point to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        small = (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = materialise(small, "cc-edges")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, and that one none: each component is a star about its smallest."""
    parents = edges.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v"))
    chained = parents.join(edges.select(F.col("u").alias("below")).distinct(), F.col("v") == F.col("below"), "left_semi")
    return parents.filter("n > 1").select("u").unionByName(chained.select("u")).isEmpty()
