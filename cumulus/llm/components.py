"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a minimum per node (combined on the map side) joined back to the
edges; each round is written to the shared folder, so no lineage grows and no
edge reaches the driver.  The node with a third of all edges is split by the
skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b); component is the smallest id reachable."""
    stars = star_edges(edges)
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def star_edges(edges: DataFrame) -> DataFrame:
    """``connected_components`` without the nodes that are the smallest of their component themselves."""
    now = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _only_stars(now):
        now = materialize(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node points to one node that points to none: then that is its component."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    per_node = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return per_node.agg(F.count_if((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1)))).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
        "u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
