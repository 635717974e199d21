"""Connected components of a link table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark.llm.rows import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Alternating large-star and small-star steps: each hangs a node's neighbours on
    the smallest of them, so the links become stars after a number of rounds that
    grows with the logarithm of the largest component. Every round is written to
    the shared folder, and the driver sees only two sums per round.
    """
    both = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(both.distinct(), "links")
    mark = None
    while True:
        edges = stored(small_star(large_star(edges)), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node, hung on the smallest of its neighbours and itself."""
    around = edges.union(edges.select("b", "a")).toDF("node", "other")
    least = around.groupBy("node").agg(F.min("other").alias("least"))
    hung = around.join(least, "node").where("other > node")
    return hung.select(F.col("other").alias("a"), F.least("node", "least").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, hung on the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    hung = edges.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.union(least.select("a", F.col("least").alias("b"))).distinct()
