"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.llm.common import written


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node, and its smaller neighbours, are linked to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    others = down.join(least, "a").filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """For edges (a, b): rows (node, component), the component being its smallest node.

    Nodes without an edge to another node have no row. A node with many
    neighbours is summed before the shuffle, and its rows are dealt out by a join that Spark can split. Each
    round is written, so that lost executors cost a round at most.
    """
    edges = edges.filter("a != b").select("a", "b")
    while True:
        edges = written(small_star(large_star(edges)), "star")
        # Done when every edge leads to a root, that is, to a node from which none leads on, and no node has
        # edges to two roots: their components are one.
        roots = edges.select(F.col("b").alias("a")).distinct()
        if not edges.select("a").join(roots, "a", "left_semi").isEmpty():
            continue
        if edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return written(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots), "parts")
