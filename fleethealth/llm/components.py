"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleethealth.llm.store import staged


def _settled(edges: DataFrame) -> bool:
    """Every node hangs on one smaller node that hangs on none: nothing can change."""
    twice = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    between = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return twice.unionByName(between).isEmpty()


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Edges run from the larger end u to the smaller end v."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    # Written first, so that the join below is between two shuffles and a node
    # with very many edges is split by adaptive execution.
    least = staged(around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    joined = around.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v"))
    return staged(out.distinct(), "edges")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b): the smallest
    node that can be reached. Ends in as many rounds as the log of the longest path."""
    edges = staged(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _settled(edges):
        edges = _step(_step(edges, True), False)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
