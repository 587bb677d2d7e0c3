"""Connected components by alternating large-star and small-star steps, wholly in DataFrames.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each step is a grouped minimum and a join back to
the edges; the minimum combines before it shuffles and adaptive execution splits a node that has very many edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.common import cut, drop_cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    down = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b: long), component being its least node.

    Any direction, repetition or loops among the edges; nodes without edges don't appear."""
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    sign = None
    while True:
        # A fixed point is a forest of stars; the sums tell any two different edge sets apart.
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("a", "b").cast("long"))).first()
        if tuple(row) == sign or not row[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        sign, before = tuple(row), now
        now = cut(_small_star(_large_star(now)))
        drop_cut(before)
