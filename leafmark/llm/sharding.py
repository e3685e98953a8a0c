"""Consistent-hash ring with virtual nodes and bounded loads.

Each shard has many points on a ring; a key goes to the first point clockwise whose shard is not full, so balance is
guaranteed, and only overflowing keys move past their own shard.  Keys are the doc_ids.

The sequential rule is planned on counts instead of keys.  Rows are counted by arc (the keys before one point); those counts,
one a virtual node, go to the driver, which walks the ring: an arc's keys, in the order of their hashes, take what room its
shard has, the rest continue clockwise.  That gives every arc a short list of (first rank, shard, first slot) cuts.  Ranks
inside an arc come from counts of finer hash cells and a window in each cell, so no task sorts more than a cell and every
slot is gapless.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import scratch

POINTS = 32
_SPACE = 1 << 31
#: Rows that a cell should hold.
CELL = 20_000


def ring(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """Sorted (position, shard) of the virtual nodes; adding a shard leaves the others' points where they were."""
    spots = {}
    for shard in range(shards):
        for k in range(points):
            at = int.from_bytes(hashlib.md5(f"shard {shard} point {k}".encode()).digest()[:4], "big") % _SPACE
            spots.setdefault(at, shard)
    return sorted(spots.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard takes: without slack the even share, the first ones one more, so counts are at most one apart."""
    even, more = divmod(rows, shards)
    if slack > 0:
        return [int((1 + slack) * rows / shards) + 1] * shards
    return [even + (shard < more) for shard in range(shards)]


def plan(nodes: list[tuple[int, int]], counts: list[int], room: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each arc its cuts (first rank, shard, first slot), by the walk that the module describes.

    First every arc fills its own shard, clockwise from position 0; then what overflows continues from its arc to the next
    points whose shards have room.
    """
    room, used = list(room), [0] * len(room)
    cuts: list[list[tuple[int, int, int]]] = [[] for _ in nodes]
    left = list(counts)
    taken = [0] * len(nodes)

    def take(arc: int, shard: int) -> None:
        n = min(left[arc], room[shard])
        if n:
            cuts[arc].append((taken[arc], shard, used[shard]))
            left[arc] -= n
            taken[arc] += n
            room[shard] -= n
            used[shard] += n

    for arc, (_, shard) in enumerate(nodes):
        take(arc, shard)
    for arc in range(len(nodes)):
        for step in range(1, len(nodes)):
            if not left[arc]:
                break
            take(arc, nodes[(arc + step) % len(nodes)][1])
    return cuts


def sharded(docs: DataFrame, shards: int = 8, points: int = POINTS, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs``.

    The law is ``rows``: counts are at most one apart without slack; with slack none exceeds (1 + slack) times the mean.
    size: UTF-8 bytes of the text (null: none) plus 1.  Equal keys (repeated rows, null ids) lie on one spot of the ring and
    are ordered by the text's checksum and size; rows equal in all three are told apart only by their slots.
    grown_shard is null: under this law room decides too.  Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    nodes = ring(shards, points)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    spot = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit(4)), F.lit(_SPACE))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), spot.alias("spot"))
    rows = scratch.written(rows, "spots")
    total = rows.count()
    cells = max(1, total // CELL)
    cell = F.floor(F.col("spot") * cells / _SPACE)
    # an arc's cell: the ring's points cut the even cells further, so a cell never spans two arcs
    edges = [p for p, _ in nodes]
    arc = _bisect(F.col("spot"), edges)
    rows = rows.withColumn("arc", F.when(arc >= len(edges), F.lit(0)).otherwise(arc)).withColumn("lap", (arc >= len(edges)).cast("int")).withColumn("cell", cell)
    fine = rows.groupBy("arc", "lap", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("arc").orderBy("lap", "cell").rowsBetween(Window.unboundedPreceding, -1)
    fine = scratch.written(fine.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "cells")
    counts = [0] * len(nodes)
    for k, n in fine.groupBy("arc").agg(F.sum("n")).collect():
        counts[k] = n
    cuts = plan(nodes, counts, capacities(total, shards, slack))
    table = [(k, lo, (part[i + 1][0] if i + 1 < len(part) else counts[k]), shard, slot) for k, part in enumerate(cuts) for i, (lo, shard, slot) in enumerate(part)]
    kinds = T.StructType([T.StructField(n, T.LongType()) for n in ("c_arc", "lo", "hi", "shard", "first")])
    table = spark.createDataFrame(table, kinds)
    inside = Window.partitionBy("arc", "lap", "cell").orderBy("spot", "doc_id", "text_crc32", "size")
    ranked = rows.join(fine.drop("n"), ["arc", "lap", "cell"]).withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)
    # at most one cut for each virtual node and shard: a fixed bound
    placed = ranked.join(F.broadcast(table), (F.col("arc") == F.col("c_arc")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), (F.col("first") + F.col("rank") - F.col("lo")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _bisect(x, edges: list[int]):
    """How many of the sorted ``edges`` are below ``x``, as a balanced tree of comparisons."""

    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x <= edges[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(edges))


def shard_of(key_spot: int, nodes: list[tuple[int, int]]) -> int:
    """The shard of a spot before loads bind; for tests and single lookups."""
    k = bisect.bisect_left([p for p, _ in nodes], key_spot)
    return nodes[k % len(nodes)][1]
