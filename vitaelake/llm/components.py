"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.sources.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest in its neighbourhood."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them; edges have u > v.

    The edge to the smallest stays as it is, every other one moves, so edges never
    become more.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return edges.join(least, "u").select(moved.alias("u"), F.col("m").alias("v"))


def _roles(edges: DataFrame) -> DataFrame:
    """(node, least, most, parent) of every node: its ends of edges, and whether it is one."""
    children = edges.select(F.col("u").alias("node"), "v", F.lit(False).alias("parent"))
    parents = edges.select(
        F.col("v").alias("node"), F.lit(None).cast(edges.schema["v"].dataType).alias("v"), F.lit(True).alias("parent")
    )
    return children.union(parents).groupBy("node").agg(
        F.min("v").alias("least"), F.max("v").alias("most"), F.max("parent").alias("parent")
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    Each step is a table in the shared folder, and edges may repeat. The rounds end
    when every node has one parent or is one, which is read off the table that gives
    the result; nothing but this answer reaches the driver. A hub's edges are
    combined before the shuffle, and the joins on it can be split. An edge with a
    NULL end is no edge, a node that only meets itself has none.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = stage(pair.filter(f"u <> v AND {a} IS NOT NULL AND {b} IS NOT NULL"), "edges")
    while True:
        current = stage(_small_star(stage(_large_star(current), "large-star")), "small-star")
        roles = stage(_roles(current), "roles")
        if roles.filter("least <> most OR (parent AND least IS NOT NULL)").isEmpty():
            return roles.select("node", F.coalesce("least", "node").alias("component"))
