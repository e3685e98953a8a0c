"""Further centres: the exact way for links that one star a bucket leaves out.

A bucket whose members lie in several components goes on with 8 more centres, then 128, 2,048 ..., in the order of a hash: each
is held against the bucket's members of other components, until the bucket has one component or each member was a centre.

Two exact rules keep pairs from becoming rows.  Two sets differ in at least as many shingles as their parity bitmaps differ in
bits, so a pair whose bitmaps are too far apart is no link.  And a pair that shares several buckets is looked at only in that of
its first common band: there, too, one of the two is a centre in the end, unless that bucket has become one component.

A bucket's members are dealt to one task for each SPLIT of them, and its centres go to each of those tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph, scratch

SPLIT = 256


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further links (a, b): only their components are joined, not all nodes again."""
    for end in ("a", "b"):
        of = roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        links = links.join(of, end, "left").withColumn(f"{end}_root", F.coalesce(f"{end}_root", end))
    more = graph.components(links, "a_root", "b_root")
    top = more.select(F.col("node").alias("root"), F.col("root").alias("top"))
    old = roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    new = more.join(roots.select("node"), "node", "left_anti")
    return scratch.written(old.unionByName(new), "roots")


def rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` (id, ...) with ``root``; who has no link is its own."""
    return members.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))


def spread(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` (key, id, ...) of buckets over several components."""
    several = rooted(members.select("key", "id"), roots).groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
    return members.join(several, "key")


def linked(members: DataFrame, sketches: DataFrame, roots: DataFrame, held: DataFrame, confirmed: Callable[[DataFrame], DataFrame], percent: int, parity: int) -> DataFrame:
    """``roots`` (node, root) after further centres in all buckets of ``members`` (key, id).

    ``sketches``: id, n (size of its set), bits (array of ``parity`` longs), keys (array of longs, by band), of all members;
    ``held``: pairs (a, b) that were compared; ``confirmed``: the links among pairs, as a written table.
    """
    apart = " + ".join(f"bit_count(bits[{k}] ^ cbits[{k}])" for k in range(parity))
    near = f"100 * least(n, m) >= {percent} * greatest(n, m) AND {100 + percent} * ({apart}) <= {100 - percent} * (n + m) AND array_intersect(keys, ckeys)[0] = key"
    open_ = members.select("key", "id", F.xxhash64("id", "key").alias("rank"), F.lit(-(2**63)).alias("upto"))
    turn, width, last = 1, 8, None
    while True:
        at = rooted(open_, roots)
        several = at.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.max("rank").alias("last"), F.max("upto").alias("done"), F.count("*").alias("size")).where("r0 <> r1 AND last > done").select("key", "size")
        at = scratch.written(at.join(several, "key"), "open")
        scratch.dropped(last)
        if at.isEmpty():
            scratch.dropped(at)
            return roots
        # centres go in the order of rank: all up to the largest of the slots' minima are taken
        slot = F.pmod(F.xxhash64("rank", F.lit(turn)), F.lit(width))
        top = at.where("rank > upto").groupBy("key", slot.alias("slot")).agg(F.min("rank").alias("rank")).groupBy("key").agg(F.max("rank").alias("top"))
        now = scratch.written(at.join(top, "key").withColumn("parts", F.ceil(F.col("size") / SPLIT).cast("int")), "turn")
        scratch.dropped(at)
        full = now.join(sketches, "id")
        centres = full.where("rank > upto AND rank <= top").select("key", F.col("id").alias("centre"), F.col("n").alias("m"), F.col("bits").alias("cbits"), F.col("keys").alias("ckeys"), F.col("root").alias("croot"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        dealt = full.withColumn("part", F.pmod(F.xxhash64("id", F.lit(turn)), F.col("parts")).cast("int"))
        pairs = dealt.join(centres, ["key", "part"]).where(f"id <> centre AND root <> croot AND {near}")
        pairs = pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
        pairs = scratch.written(pairs.join(held, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            more = scratch.written(held.unionByName(pairs), "held")
            fresh = confirmed(pairs)
            if not fresh.isEmpty():
                roots = merged(roots, fresh)
            scratch.dropped(held if turn > 1 else None, fresh)
            held = more
        scratch.dropped(pairs)
        open_, last = now.select("key", "id", "rank", F.col("top").alias("upto")), now
        turn, width = turn + 1, width * 16
