"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Each step is one aggregate and one join over the edges; the edges of a round are written to the
cluster's shared folder. No adjacency list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    low = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = down.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """True when every node has one edge down and no lower end has one itself: all ends are roots."""
    per = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("b"))
    above = edges.select(F.col("a").alias("top")).distinct()
    return per.join(above, F.col("b") == F.col("top"), "left").where((F.col("n") > 1) | F.col("top").isNotNull()).isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge: root is the smallest node it can reach."""
    edges = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b"), "cc")
    for _ in range(MAX_ROUNDS):
        edges = written(_small_star(_large_star(edges)), "cc")
        if _stars(edges):
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
