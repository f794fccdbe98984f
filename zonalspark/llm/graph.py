"""Connected components as DataFrame joins, for the similarity join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import forget, written


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node of its component, for every node of an edge but the roots.

    Alternating large-star and small-star rounds: every round hangs the
    neighbours of a node under its smallest one. Minima are combined before the
    shuffle, so that a hub is no burden; every round is written to the shared
    folder. Edges of a node with itself are left out.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join with the edges of a hub is one of files, which Spark can split
        leasts = [written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least")]
        large = written(both.join(leasts[0], "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        leasts.append(written(large.groupBy("u").agg(F.min("v").alias("m")), "least"))
        small = large.join(leasts[1], "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u > v").distinct()
        old, now = now, written(small, "edges")
        forget(old, large, *leasts)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
