"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.base import stage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that edges (``a``, ``b``) reach from it; only nodes with an edge to another.

    Each step replaces edges by shorter ways to smaller nodes; their number never grows. Steps end when the table does
    not change, after about the logarithm of the longest way. Every step is written to the shared folder. A node's
    neighbours are never gathered: their minimum is aggregated and joined back.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(now.join(least, "a").select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        now = stage(small, "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    found = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
