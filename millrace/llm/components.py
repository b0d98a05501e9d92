"""Connected components of an edge table, by large-star and small-star steps.

Each step is a map-side combined minimum per node and an equi-join on the node, which AQE splits where
a node has very many neighbours. Nothing is collected; each round is written to the shared folder, so
a lost executor costs one round at most. The number of rounds grows with the logarithm of the longest
path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung under the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).withColumn("m", F.least("node", "m"))
    return both.where("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung under the smallest of them. Edges come as (larger, smaller)."""
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node it can reach. Edges: columns a, b."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = store(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        seen = state
        edges = store(_small_star(_large_star(edges)), "edges")
