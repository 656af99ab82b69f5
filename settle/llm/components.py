"""Connected components of a stored table of edges, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on the smallest node next to it."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")
    return moved.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b")
    hung = moved.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
    return hung.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), a < b; root is its component's smallest node.

    Alternates large and small stars, each round stored in the shared folder,
    until every edge leads to a root; the rounds grow with the logarithm of the
    longest chain. Joins on a hub are split by adaptive execution.
    """
    while True:
        inner = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        many = edges.groupBy("b").agg(F.count("*").alias("n")).where("n > 1")
        if inner.isEmpty() and many.isEmpty():
            break
        edges = store(_small_star(_large_star(edges)), "components")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)
