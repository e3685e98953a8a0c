"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

Plan, all of it distributed:

1. one Python pass turns each whole text into its distinct 5-word shingles, their count, a 128-bit set digest and band keys;
2. rows of one set digest and size are one class with a number of its own, so copies never meet in a bucket;
3. every bucket links its members to one centre, another centre in each band, so a bucket of n costs n - 1 candidates;
4. candidates are confirmed on the full shingle sets; confirmed links are joined by distributed union-find;
5. buckets whose members still lie in several components go on with further centres (see ``further``), so that variants around
   one text do not meet pair by pair: the exact way for what one star cannot link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from . import further, graph, scratch
from . import rows as R

BINS, BANDS, ROWS = 128, 25, 5
PARITY = 16
_EMPTY = np.uint64(2**64 - 1)


def signatures(hashes: np.ndarray, owner: np.ndarray, docs: int, bins: int = BINS) -> np.ndarray:
    """One-permutation signatures (docs x bins) of sorted distinct hashes; an empty bin borrows by optimal densification:

    bin i tries bins h(i, 1), h(i, 2), ... until one of its own document's bins holds a value.  Rows without hashes stay empty.
    """
    mixed = B.mix(hashes, 3)
    shift = np.uint64(64 - int(bins).bit_length() + 1)
    cell = owner * bins + (mixed >> shift).astype(np.int64)
    sig = np.full(docs * bins, _EMPTY, B.U)
    order = np.lexsort((mixed, cell))
    cell, mixed = cell[order], mixed[order]
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    sig[cell[first]] = mixed[first]
    sig = sig.reshape(docs, bins)
    full = sig != _EMPTY
    row, col = np.nonzero(~full & full.any(1)[:, None])
    out, attempt = sig.copy(), 1
    while len(row):
        probe = (B.mix(col.astype(B.U) * B.U(65_537) + B.U(attempt), 5) % B.U(bins)).astype(np.int64)
        hit = full[row, probe]
        out[row[hit], col[hit]] = sig[row[hit], probe[hit]]
        row, col, attempt = row[~hit], col[~hit], attempt + 1
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.zeros((len(sig), bands), B.U)
    with np.errstate(over="ignore"):
        for k in range(rows):
            out = out * B.U(0xD6E8FEB86659FD93) + sig[:, k : bands * rows : rows]
        return B.mix(out + np.arange(bands, dtype=B.U) * B.U(0x9E3779B97F4A7C15), 13).view(np.int64)


def _digests(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over each document's hashes: one digest of the set."""
    digest = np.zeros((2, len(n)), B.U)
    some = n > 0
    begin = np.concatenate([[0], np.cumsum(n)[:-1]])[some]
    if len(begin):
        for k in (0, 1):
            digest[k, some] = np.add.reduceat(B.mix(h, 17 + k), begin)
    return digest.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offsets in B.chunks(batch.column(1)):
            h, owner, n = B.shingle_sets(buf, offsets)
            docs, some = hi - lo, n > 0
            digest = _digests(h, n)
            keys = band_keys(signatures(h, owner, docs))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)), pa.array(keys[some].ravel()))
            own = [batch.column(k).slice(lo, docs) for k in (0, 2, 3)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n.astype(np.int64)), pa.array(digest[0]), pa.array(digest[1]), lists], ["doc_id", "at", "place", "n_shingles", "h1", "h2", "keys"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows id, text, h1, h2 -> id, shingles, where the text has that digest (an id's other texts are other classes')."""
    for batch in batches:
        for lo, hi, buf, offsets in B.chunks(batch.column(1)):
            h, _, n = B.shingle_sets(buf, offsets)
            digest = _digests(h, n)
            own = [batch.column(k).slice(lo, hi - lo) for k in (0, 2, 3)]
            good = (digest[0] == own[1].to_numpy()) & (digest[1] == own[2].to_numpy())
            ends = np.concatenate([[0], np.cumsum(n)]) * 8
            packed = pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(h))])
            yield pa.RecordBatch.from_arrays([own[0].filter(pa.array(good)), packed.filter(pa.array(good))], ["id", "shingles"])


def _parity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PARITY x 64 bits a set: bit k tells whether an odd number of its shingles falls to cell k."""
    for batch in batches:
        bits = np.zeros((batch.num_rows, PARITY * 64), np.uint8)
        for i, x in enumerate(batch.column(1)):
            cell = B.mix(np.frombuffer(x.as_buffer(), B.U), 23) % B.U(PARITY * 64)
            bits[i] = np.bincount(cell.astype(np.int64), minlength=PARITY * 64) & 1
        longs = np.packbits(bits, axis=1).view(np.int64).ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * PARITY), pa.array(longs))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "bits"])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), B.U), np.frombuffer(y.as_buffer(), B.U)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * common >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good))], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two texts are linked when 100 * intersection >= ``percent`` * union of their shingle sets (``percent`` 80 or more suits
    the 25 bands of 5: a pair at 0.80 is missed with probability 5e-5, at 0.85 with 4e-7).
    A null, empty or wordless text has no shingles and is linked with nothing (component_id is its doc_id); fewer than five
    words make one shingle.  Rows that repeat a doc_id are judged by their own texts.  A row without doc_id is linked like any
    other but never names a component; one without any doc_id has component_id null, and its rows are kept.
    Other columns, whatever their names, are not read.  An empty table gives an empty result.
    """
    out = _components(docs.withColumn(R.PLACE, F.lit(None).cast("string")), id_col, text_col, percent)
    return out.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


def _components(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """doc_id, place, n_shingles, root (of the row's class; null without shingles), component_id for each row of ``docs``."""
    text = F.col(text_col).cast("string")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("at"), F.col(R.PLACE).alias("place"))
    sketch = scratch.passed(ids, _sketch, "doc_id long, at long, place string, n_shingles long, h1 long, h2 long, keys array<long>")
    sketch = scratch.written(sketch.withColumn("row", F.monotonically_increasing_id()), "sketch")
    # a class is found again by the doc_id (or else text) of one of its rows; rows are numbered once, in the written table
    equal = ["n_shingles", "h1", "h2"]
    classes = sketch.where("n_shingles > 0").groupBy(*equal).agg(F.min(F.struct("at", "row")).alias("first"))
    member = sketch.join(classes, equal, "left").withColumn("id", F.col("first.row"))
    member = scratch.written(member.select("doc_id", "place", "at", *equal, "id", F.expr("CASE WHEN row = id THEN keys END").alias("keys")), "member")
    scratch.dropped(sketch)

    reps = member.where("keys is not null")
    exploded = reps.select("id", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    buckets = exploded.groupBy("key").agg(F.count("*").alias("size"), F.min(F.xxhash64("id", "key")).alias("low")).where("size > 1")
    bucket = scratch.written(exploded.join(buckets, "key").withColumn("rank", F.xxhash64("id", "key")), "bucket")
    needed = reps.join(bucket.select("id").distinct(), "id", "left_semi").select("id", "at", "h1", "h2")
    packed = scratch.passed(ids.join(needed, "at").select("id", "text", "h1", "h2"), _pack, "id long, shingles binary")
    if not member.groupBy("at").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        packed = packed.dropDuplicates(["id"])
    sets = scratch.written(packed, "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        full = pairs.join(x, "a").join(y, "b").select("a", "b", "sa", "sb")
        return scratch.written(scratch.passed(full, _confirm(percent), "a long, b long"), "links")

    centres = bucket.where("rank = low").select("key", F.col("id").alias("centre"), F.col("n").alias("m"))
    stars = bucket.join(centres, "key").where(f"id <> centre AND 100 * least(n, m) >= {percent} * greatest(n, m)")
    stars = scratch.written(stars.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct(), "stars")
    links = confirmed(stars)
    roots = graph.components(links)
    scratch.dropped(links)

    members = scratch.written(further.spread(bucket.where("size > 2").select("key", "id"), roots), "spread")
    bits = scratch.passed(sets.join(members.select("id").distinct(), "id", "left_semi"), _parity, "id long, bits array<long>")
    sketches = scratch.written(bits.join(reps.select("id", F.col("n_shingles").alias("n"), "keys"), "id"), "sketches")
    roots = further.linked(members, sketches, roots, stars, confirmed, percent, PARITY)
    scratch.dropped(bucket, sets, stars, members, sketches)

    own = further.rooted(member.where("id is not null").groupBy("id").agg(F.min("doc_id").alias("least")), roots)
    own = scratch.written(own, "classes")
    best = own.groupBy("root").agg(F.min("least").alias("component_id"))
    of = own.join(best, "root").select("id", "root", "component_id")
    out = member.select("doc_id", "place", "n_shingles", "id").join(of, "id", "left")
    return out.select("doc_id", "place", "n_shingles", "root", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (null last; ties by place), all columns kept."""
    docs = R.placed(docs)
    at = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), "place")
    rows = scratch.written(_components(docs, "doc_id", "text", percent).where("root is not null").select("root", at.alias("at")), "rows")
    best = rows.groupBy("root").agg(F.min("at").alias("best"))
    return R.without(docs, rows.join(best, "root").where("at <> best").select("at.place"))
