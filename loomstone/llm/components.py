"""Connected components of an edge table, by alternating large-star and small-star steps (Kiveris et al., 2014).

Each step is a minimum per node, pre-aggregated before its shuffle, and a join whose hot side the planner can split.
The table holds at most one row per edge and shrinks to one row per node; every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v), both long; root is the smallest node of the component."""
    held = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    before = None
    while (now := _state(held)) != before:
        before = now
        held = staged(_small_star(staged(_large_star(held), "large-star")), "small-star")
    leaves = held.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour larger than a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least, "u").where("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
