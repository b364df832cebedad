"""Distributed union-find on DataFrame operations: large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormglass.llm.scratch import Scratch


def _smallest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each vertex.

    The key is computed anew, so that the join on it shuffles both sides and adaptive execution can
    split a vertex with very many edges; joined on the grouping column itself it could not.
    """
    found = edges.groupBy("u").agg(F.min("v").alias("least"))
    return found.select((F.col("u") + F.lit(0)).alias("k"), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_smallest(both), F.col("u") == F.col("k")).where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select(F.col("k").alias("u"), F.col("least").alias("v"))
    return moved.where("u <> v").unionByName(own).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every vertex has one parent and no child, or children and no parent."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counted = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where("up + down > 1").isEmpty()


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Component of every vertex that has an edge to another: (vertex, component), its smallest member.

    edges: columns a and b of type long. Self loops, repeats and null ends count for nothing; an empty
    table gives an empty table. Each round writes its edges to the shared folder, and the rounds end
    when every component is a star around its smallest member, so no component or link list comes to the driver.
    """
    current = (
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    current = scratch.stage(current, "edges")
    while not _is_forest_of_stars(current):
        current = scratch.stage(_small_star(_large_star(current)), "edges")
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
