"""Connected components by alternating large-star and small-star steps on a table of edges.

Nothing is collected: a step is an aggregate for the smallest neighbour and a join, and the
edges are written after it. Ends when a round leaves the edges as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestore.llm.common import release, stored


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), in any direction, repeated or not -> node, component: the smallest node that it reaches.

    Nodes without an edge to another node are not in the result; edges with a null end are ignored.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    e = stored(e.distinct(), "edges")
    mark = _mark(e)
    while True:
        before, e = e, stored(_small_star(_large_star(e)), "edges")
        release(before)
        last, mark = mark, _mark(e)
        if last == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """e: u above v."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    turned = e.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
