"""Connected components by alternating large-star and small-star, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch


def _relink(edges: DataFrame, to: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) with ``a`` replaced by its ``to`` where it has one, loops left out.

    ``to`` is stored first, so that both sides of the join are plain exchanges and a node
    with very many edges is split over several tasks.
    """
    to = scratch(to, "to")
    return (edges.join(to, "a", "left")
            .select(F.coalesce("to", "a").alias("a"), "b").where("a < b").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger node has one edge and is the smaller node of none."""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("lower"), F.lit(0).alias("upper"))
            .unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("lower"), F.lit(1).alias("upper"))))
    return (ends.groupBy("node").agg(F.max("lower").alias("lower"), F.sum("upper").alias("upper"))
            .where("upper > 1 or lower = 1 and upper = 1").isEmpty())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component is its least node.

    Large-star ties the larger neighbours of each node to its least neighbour, small-star
    ties the smaller ones to their least; in turn they end in one star per component, after
    a number of rounds that grows with the logarithm of the longest path.  Nulls and loops
    tie nothing; no edges give no rows.  Each round is stored in the shared folder.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "components")
    edges = scratch(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "edges")
    while not _are_stars(edges):
        # Large-star: a's larger neighbours go to the least of a's neighbours.
        least = (edges.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("to")))
        edges = scratch(_relink(edges, least.withColumnRenamed("x", "a"), scratch), "large")
        # Small-star: b's smaller neighbours, and b, go to the least of them.
        low = edges.groupBy("b").agg(F.min("a").alias("to"), F.count("*").alias("n"))
        low = scratch(low.where("n > 1").drop("n"), "low")
        both = edges.join(low, "b", "left")
        edges = scratch(
            both.select(F.coalesce("to", "a").alias("a"), "b")
            .unionByName(both.where("to < a").select(F.col("to").alias("a"), F.col("a").alias("b")))
            .where("a < b").distinct(), "small")
    return (edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct())
