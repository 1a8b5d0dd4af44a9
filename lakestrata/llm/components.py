"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import save


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b of type long) -> node, label: the smallest node that each linked node can reach.

    Nodes without an edge have no row. Every round is stored, so a lost executor repeats one round at
    most; rounds grow with the logarithm of the longest path.
    """
    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()

    now = save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "edges")
    seen = mark(now)
    while seen.n:
        now = save(_small_star(_large_star(now)), "edges")
        last, seen = seen, mark(now)
        if seen == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")) \
        .union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
