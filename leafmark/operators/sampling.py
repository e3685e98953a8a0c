"""Deterministic samples: quotas by kind, thirds by length, even spacing.  Order is that of a hash, so any engine repeats it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hash_order(key: str, seed: int = 0) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def quota_sample(rows: DataFrame, kind: str, key: str, quotas: dict[str, int], seed: int = 0) -> DataFrame:
    """The first rows of each kind in hash order, as many as its quota."""
    limit = F.lit(0)
    for name, n in quotas.items():
        limit = F.when(F.col(kind) == name, n).otherwise(limit)
    w = Window.partitionBy(kind).orderBy(hash_order(key, seed), key)
    return rows.where(F.col(kind).isin(list(quotas))).withColumn("r", F.row_number().over(w)).where(F.col("r") <= limit).drop("r")


def thirds(rows: DataFrame, size: str, key: str) -> DataFrame:
    """third 0, 1 or 2 by rank of ``size``; the last takes the remainder.

    Ranks come from counts by size, which are few, and from order inside one size, so no window holds all rows.
    """
    counts = rows.groupBy(size).agg(F.count("*").alias("c"))
    before = Window.orderBy(size).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(size, F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"), F.sum("c").over(Window.partitionBy()).alias("total"))
    w = Window.partitionBy(size).orderBy(key)
    ranked = rows.join(base, size).withColumn("rank", F.col("base") + F.row_number().over(w) - 1)
    return ranked.withColumn("third", F.least(F.lit(2), F.floor(F.col("rank") / F.greatest(F.lit(1), F.floor(F.col("total") / 3)))).cast("int")).drop("base", "total")


def length_sample(rows: DataFrame, size: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows, a third of them from each third by length (the first n % 3 thirds one more), in hash order."""
    ranked = thirds(rows, size, key)
    quota = F.lit(n // 3) + (F.col("third") < n % 3).cast("int")
    w = Window.partitionBy("third").orderBy(hash_order(key, seed), key)
    return ranked.withColumn("r", F.row_number().over(w)).where(F.col("r") <= quota).drop("r", "rank")


def even_indices(total: int, k: int) -> list[int]:
    """At most k page numbers, evenly spaced from 0."""
    return sorted({i * total // k for i in range(k)}) if total > k else list(range(total))
