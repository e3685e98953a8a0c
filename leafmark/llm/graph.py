"""Distributed union-find: connected components by alternating large-star and small-star steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``edges`` (two id columns) -> (node, root): root is the smallest id reachable.

    Each round links all larger neighbours of a node to its smallest neighbour (large star), then all smaller ones
    (small star); the edge set never grows, each round is one pre-aggregated shuffle a step, and rounds grow with the
    logarithm of the longest path.  Nulls and self-links are ignored; without edges the result is empty.
    Lineage is cut by a written table each round.  Nothing but two numbers a round reaches the driver.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    path, last = scratch.new_dir(spark, "edges"), None
    e = scratch.written(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", path)
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e = large.join(small, "u")
        e = e.select("u", F.col("m").alias("v")).unionByName(e.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        old, path = path, scratch.new_dir(spark, "edges")
        e = scratch.written(e.distinct(), "edges", path)
        scratch.removed(spark, old)
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
