"""Connected components by alternating large and small stars over edge tables; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shuffled, written


def components(edges: DataFrame, name: str) -> DataFrame:
    """edges (a, b) -> (node, root): root is the smallest node reachable; nodes that are roots are left out.

    Null ends and loops are ignored. Each star is a map-side combined minimum and a join of written tables, whose large
    keys Spark can split, so a node with very many edges is no group in one task. Tables of earlier rounds are removed.
    """
    now = written(edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    while not _stars(now):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select("b", "a"))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = written(both.join(shuffled(low), "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct(), name)
        discard(now, low)
        low = written(large.groupBy("b").agg(F.min("a").alias("m")), name)
        joined = large.join(shuffled(low), "b")
        small = joined.select(F.col("m").alias("a"), "b").unionAll(joined.select(F.least("a", "m"), F.greatest("a", "m")))
        now = written(small.where("a <> b").distinct(), name)
        discard(large, low)
    out = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    out._written_path = now._written_path  # for discard()
    return out


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or larger ones only."""
    ends = edges.select(F.col("b").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionAll(edges.select("a", F.lit(0), F.lit(1)))
    sums = ends.groupBy("n").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return sums.where("low > 1 or (low > 0 and high > 0)").agg(F.count("*")).head()[0] == 0
