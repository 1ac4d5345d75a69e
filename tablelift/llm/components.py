"""Connected components of an edge table by alternating stars; every half round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import stored


def _least(edges: DataFrame, name: str) -> DataFrame:
    """The least neighbour ``m`` of each node that has smaller ones; the node is called ``name``."""
    return edges.groupBy(F.col("a").alias(name)).agg(F.min("b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least node it knows. An edge's ``b`` is below its ``a``, here and in the result."""
    return edges.join(_least(edges, "b"), "b", "left").select("a", F.coalesce("m", "b").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours, and the node itself, to the least of them; the edge to the least brings the node itself."""
    return edges.join(_least(edges, "a"), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or both a smaller and a larger one: then each edge ends at the least node of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.where("below > 1 OR below = 1 AND above = 1").agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; component is the least node. Columns of ``edges``: a, b."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # Each half round is a query of its own: plans of whole rounds repeat their parts and fill the driver's memory.
    while not _are_stars(edges):
        edges = stored(_small_star(stored(_large_star(edges))))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
