"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import saved


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges to (node, root): root is the smallest node that node can reach.

    Nodes that are no end of an edge between two different nodes are left out. Each step only
    joins edges with one minimum per node; nothing is gathered. Rounds grow as the logarithm
    of the longest path.
    """
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        small = small.select("b", "m").unionAll(small.select(F.col("a").alias("b"), "m")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        e = saved(small, "edges")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
