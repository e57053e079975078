"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm.support import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is tied to the smallest neighbour of u."""
    both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("u", "m"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, root) for each id on an edge (a, b); root is the smallest id that it reaches.

    Rounds of joins and grouped minima, each stored in the shared folder; they end
    when the edges no longer change, after about log(n) rounds. A hub of any degree
    is a skewed join key, which adaptive execution splits, never one task's group.
    """
    current = materialise(spark, edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        stars = _small_star(_large_star(current)).where("a <> b").distinct()
        current = materialise(spark, stars, "stars")
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    members = current.select(F.col("a").alias("id"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    return materialise(spark, members.union(roots), "components")
