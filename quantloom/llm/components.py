"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): each node of an edge (a, b) and the smallest node that it reaches.

    Each round cuts its lineage. Rounds grow with the logarithm of the longest chain; a hub's edges
    are joined by plain equi-joins, which adaptive execution splits.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(smallest.select("a", F.col("m").alias("b")))
        now = cut(small.where("a <> b").distinct(), "edges")
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
