"""Fuzzy line dedup: character-shingle MinHash, high-recall banding, exact Jaccard, distributed union-find.

1. One Python pass cuts whole texts into lines and gives each its digest and, once a task, its text.
   Shingles are windows of 8 bytes that start at each character; one-permutation signatures of 64 bins give 16 bands of 4:
   a pair at 0.80 is missed with probability 2e-4, at 0.85 with 7e-6, at 0.90 with 4e-8.
2. Equal lines have one id, so they never pair.  Only (band key, id) is shuffled, once, packed by cells of keys, and each cell
   is sorted by key where it arrives; each further line of a bucket becomes a candidate with the bucket's centre and with its neighbour, in the order of a hash of that band, so n
   lines cost under 2n pairs.
3. Candidates are confirmed by the Jaccard similarity of their full shingle sets; confirmed links go to union-find.
4. Buckets whose lines still lie in several components go on with further centres (see ``further``).
5. Of each component the line that comes first (doc_id, line_no) is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from . import further, graph, scratch
from .near_dedup import band_keys

SHINGLE, BINS, BANDS, ROWS = 8, 64, 16, 4
PARITY = 8
#: Digests that a task remembers.
_SEEN = 500_000
_EMPTY = np.uint64(2**64 - 1)
#: Pairs of key and id: those of a cell on average, those that a task deals to cells at once, and those of a cell that are sorted at once.
CELL, DEAL, HELD = 1 << 16, 1 << 20, 1 << 22


def _raw(buf: bytes | np.ndarray) -> np.ndarray:
    """Each 8 neighbouring bytes as one number: a view that moves by one byte."""
    return np.ndarray((max(len(buf) - SHINGLE + 1, 0),), "<u8", buf, 0, (1,))


def _windows(buf: np.ndarray) -> np.ndarray:
    """The same, mixed."""
    with np.errstate(over="ignore"):
        out = _raw(np.ascontiguousarray(buf)) * B.U(0x9E3779B97F4A7C15)
        out ^= out >> B.U(29)
        out *= B.U(0xBF58476D1CE4E5B9)
        out ^= out >> B.U(32)
    return out


def shingles(line: bytes) -> np.ndarray:
    """The distinct shingles of a normalised line, sorted; a shorter line is its own only shingle."""
    if len(line) < SHINGLE:
        return np.frombuffer(hashlib.blake2b(line, digest_size=8).digest(), B.U)
    own = _raw(line)
    if not line.isascii():
        own = own[(np.frombuffer(line, np.uint8, len(own)) & 0xC0) != 0x80]
    own = np.sort(own)
    new = np.empty(len(own), bool)
    new[0] = True
    np.not_equal(own[1:], own[:-1], out=new[1:])
    return own[new]


_FOLD = bytes(B.LOWER)
_OUTER = b" \t\n\x0b\x0c\r"


def lines_of(text: bytes) -> list[tuple[int, bytes]]:
    """(number from 0, line) of the lines that have a word: A-Z lower-cased, white space outside trimmed."""
    return [(n, line) for n, raw in enumerate(text.translate(_FOLD).split(b"\n")) if (line := raw.strip(_OUTER))]


def line_signatures(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One-permutation signatures of neighbouring lines, empty bins filled by optimal densification."""
    lines = len(offsets) - 1
    sig = np.full((lines, BINS), _EMPTY, B.U)
    if lines == 0 or len(buf) < SHINGLE:
        return sig
    h = _windows(buf)
    inside = (buf[: len(h)] & 0xC0) != 0x80
    for k in range(1, SHINGLE):  # windows that would reach into the next line
        at = offsets[1:-1] - k
        inside[at[(at >= 0) & (at < len(h))]] = False
    cell = np.repeat(np.arange(0, lines * BINS, BINS, dtype=np.int64), np.diff(offsets))[: len(h)]
    cell += (h >> B.U(58)).view(np.int64)
    np.minimum.at(sig.reshape(-1), cell[inside], h[inside])
    full = sig != _EMPTY
    row, col = np.nonzero(~full & full.any(1)[:, None])
    out, attempt = sig.copy(), 1
    while len(row):
        probe = (B.mix(col.astype(B.U) * B.U(65_537) + B.U(attempt), 29) % B.U(BINS)).astype(np.int64)
        hit = full[row, probe]
        out[row[hit], col[hit]] = sig[row[hit], probe[hit]]
        row, col, attempt = row[~hit], col[~hit], attempt + 1
    return out


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of lines; a task sends the text of a line once (its memory of digests is bounded), so copies cost 16 bytes."""
    seen: set[bytes] = set()
    for batch in batches:
        for lo, hi, buf, offsets in B.chunks(batch.column(1)):
            raw, own, number, counts = buf.tobytes(), [], [], []
            for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                got = lines_of(raw[i:j])
                counts.append(len(got))
                number += [n for n, _ in got]
                own += [line for _, line in got]
            ids = [hashlib.blake2b(x, digest_size=16).digest() for x in own]
            texts: list[bytes | None] = []
            for x, line in zip(ids, own, strict=True):
                texts.append(None if x in seen else line)
                seen.add(x)
            if len(seen) > _SEEN:
                seen.clear()
            docs = batch.column(0).slice(lo, hi - lo).take(pa.array(np.repeat(np.arange(hi - lo), counts)))
            halves = np.frombuffer(b"".join(ids), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), docs, pa.array(number, pa.int64()), pa.array(texts, pa.binary())], ["id", "more", "doc_id", "line_no", "line"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offsets in B.chunks(batch.column(1).cast(pa.string(), safe=False)):
            keys = band_keys(line_signatures(buf, offsets), BANDS, ROWS)
            rows = batch.column(0).slice(lo, hi - lo).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(rows, BANDS))], ["key", "id"])


def _dealt(cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keys and ids of lines, packed: a row for each cell of keys, so that pairs are no rows in the shuffle."""

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        pairs = np.stack([np.concatenate([p.column(k).to_numpy() for p in parts]) for k in (0, 1)], 1)
        cell = (pairs[:, 0].view(B.U) % B.U(cells)).astype(np.uint16 if cells <= 1 << 16 else np.int64)
        order = np.argsort(cell, kind="stable")
        cell, pairs = cell[order], pairs[order]
        begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        ends = (np.concatenate([begin, [len(cell)]]) * 16).astype(np.int32)
        blobs = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(pairs)])
        return pa.RecordBatch.from_arrays([pa.array(cell[begin].astype(np.int64)), blobs], ["cell", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in _keys(batches):
            held.append(rows)
            size += rows.num_rows
            if size >= DEAL:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell -> keys and ids, sorted by key inside a cell.

    A cell of more than HELD pairs (a key with very many lines) comes in parts: of each key the row of the lowest rank comes
    again in the next part, so that it links the parts' stars.
    """
    held: list[np.ndarray] = []
    cell, size, most = None, 0, HELD

    def ordered() -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
        pairs = np.concatenate(held)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        keys, ids = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
        return keys, ids, pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], ["key", "id"])

    for batch in batches:
        for at, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if at != cell and held:
                yield ordered()[2]
                held, size, most = [], 0, HELD
            cell = at
            held.append(np.frombuffer(blob.as_buffer(), np.int64).reshape(-1, 2))
            size += len(held[-1])
            if size > most:
                keys, ids, rows = ordered()
                yield rows
                order = np.lexsort((B.mix(ids.view(B.U) ^ keys.view(B.U), 31), keys))
                keys, ids = keys[order], ids[order]
                first = np.concatenate([[True], keys[1:] != keys[:-1]])
                held = [np.stack([keys[first], ids[first]], 1)]
                size = len(held[0])
                most = max(HELD, 2 * size)
    if held:
        yield ordered()[2]


def _cell_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _stars(_unpacked(batches))


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: pairs (and their key) of each row of a bucket with its centre, the row of the lowest rank, and with
    the next by rank.

    Ranks are hashes of id and key, so each band has its own centre and order.  A bucket that goes on in the next batch keeps
    its centre so far; if a later row ranks lower, both are paired and the later one takes over.
    """
    key = centre = low = None
    for batch in batches:
        keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        same = keys[1:] == keys[:-1]
        several = np.zeros(len(keys), bool)
        several[1:] |= same
        several[:-1] |= same
        if key is not None and keys[0] == key:
            several[0] = True
        at = np.flatnonzero(several)
        last_key, last_id = keys[-1], ids[-1]
        if len(at):
            k, x = keys[at], ids[at]
            rank = B.mix(x.view(B.U) ^ k.view(B.U), 31)
            order = np.lexsort((rank, k))
            # sorted keys stay in their places: lexsort only orders rows inside a bucket
            x, rank = x[order], rank[order]
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            begin = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
            head, before = x[begin], np.concatenate([x[:1], x[:-1]])
            a, b, c = [x[~new], x[~new]], [head[~new], before[~new]], [k[~new], k[~new]]
            tail = int(begin[-1])
            if key is not None and k[0] == key:  # the open bucket goes on
                a.append(x[:1])
                b.append(np.array([centre]))
                c.append(k[:1])
            if k[-1] == last_key:
                best, least = x[tail], rank[tail]
                if tail == 0 and key is not None and k[0] == key and low <= least:
                    best, least = centre, low
                centre, low = best, least
            left, right = np.concatenate(a), np.concatenate(b)
            good = left != right
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(left, right)[good]), pa.array(np.maximum(left, right)[good]), pa.array(np.concatenate(c)[good])], ["a", "b", "key"])
        if not len(at) or keys[at[-1]] != last_key:
            centre, low = last_id, B.mix(np.array([last_id]).view(B.U) ^ np.array([last_key]).view(B.U), 31)[0]
        key = last_key


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of a line's shingles, PARITY x 64 bits (bit k tells whether an odd number of them falls to cell k), its keys."""
    for batch in batches:
        bits, n = np.zeros((batch.num_rows, PARITY * 64), np.uint8), np.zeros(batch.num_rows, np.int64)
        for i, line in enumerate(batch.column(1).to_pylist()):
            own = shingles(line)
            cell = B.mix(own, 23) % B.U(PARITY * 64)
            bits[i], n[i] = np.bincount(cell.astype(np.int64), minlength=PARITY * 64) & 1, len(own)
        longs = np.packbits(bits, axis=1).view(np.int64)
        texts = batch.column(1).cast(pa.string(), safe=False)
        keys = np.concatenate([np.zeros((0, BANDS), np.int64), *(band_keys(line_signatures(buf, offsets), BANDS, ROWS) for _, _, buf, offsets in B.chunks(texts))])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), _lists(longs), _lists(keys)], ["id", "n", "bits", "keys"])


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            y, ys = None, None
            for i, (x, line) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if line != y:  # rows come sorted by their second line
                    y, ys = line, shingles(line)
                xs = shingles(x)
                if 100 * min(len(xs), len(ys)) < percent * max(len(xs), len(ys)):
                    continue
                both = np.concatenate([xs, ys])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good[i] = 100 * common >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good))], ["a", "b"])

    return run


def fuzzy_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each line with a word: doc_id, line_no (from 0), n_lines (of its component), keep_doc, keep_line, kept.

    Lines are compared without outer white space and without A-Z case; linked at 100 * intersection >= ``percent`` * union of
    their shingles.  Lines of under 8 bytes are linked only when equal.  Null, empty and wordless texts have no lines; rows that
    repeat a doc_id have equal line numbers and one kept line if equal.  Null doc_ids come last.  No other column is read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with scratch.unshuffled(docs.sparkSession):
        lines, roots = _linked(rows, percent)
    place = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), "line_no")
    of = further.rooted(lines.select("id", "doc_id", "line_no"), roots)
    whole = of.groupBy("root").agg(F.min(place).alias("keep"), F.count("*").alias("n_lines")).where("n_lines > 1")
    out = of.join(whole, "root", "left")
    keep = F.coalesce("keep", place)
    return out.select("doc_id", "line_no", F.coalesce("n_lines", F.lit(1)).cast("long").alias("n_lines"), F.nullif(keep["doc_id"], F.lit(2**63 - 1)).alias("keep_doc"), keep["line_no"].alias("keep_line"), (place == keep).alias("kept"))


def _linked(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The lines of ``rows`` (doc_id, text): id, doc_id, line_no and more; and the root of each id (node) that has a link."""
    spark = rows.sparkSession
    path, schema = scratch.new_dir(spark, "lines"), "id long, more long, doc_id long, line_no long, line binary"
    # dictionaries of texts and hashes would be built only to be given up; the table is read twice, so little is spent on packing it
    scratch.passed(rows, _lines, schema).write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "1", **{f"parquet.enable.dictionary#{c}": "false" for c in ("id", "more", "line")}}).parquet(path)
    lines = _distinct_ids(spark.read.schema(schema).parquet(path))
    first = lines.where(f"line is not null AND length(line) >= {SHINGLE}").select("id", "line")
    cells = -(-spark.read.schema(schema).parquet(path).count() * BANDS // CELL) or 1
    keyed = scratch.passed(first.select("id", "line"), _dealt(cells), "cell long, pairs binary").repartition(F.col("cell")).sortWithinPartitions("cell")
    stars = scratch.written(scratch.passed(keyed, _cell_stars, "a long, b long, key long"), "stars")
    pairs = scratch.written(stars.select("a", "b").distinct(), "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = scratch.written(first.join(needed, "id", "left_semi").dropDuplicates(["id"]), "texts")
    x = texts.select(F.col("id").alias("a"), F.col("line").alias("x"))
    y = texts.select(F.col("id").alias("b"), F.col("line").alias("y"))

    def confirmed(candidates: DataFrame) -> DataFrame:
        full = candidates.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return scratch.written(full.mapInArrow(_confirm(percent), "a long, b long"), "links")

    links = confirmed(pairs)
    roots = graph.components(links)
    scratch.dropped(links)
    # the pairs of a star connect all lines of its bucket, so a bucket over several components has a pair over two
    apart = pairs
    for end in ("a", "b"):
        apart = apart.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
    apart = apart.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
    several = stars.join(apart, ["a", "b"], "left_semi").select("key").distinct()
    open_ = scratch.written(stars.join(several, "key", "left_semi"), "apart")
    # a bucket of two has been compared
    larger = open_.groupBy("key").agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1")).where("a0 <> a1 OR b0 <> b1").select("key")
    members = scratch.written(open_.join(larger, "key", "left_semi").select("key", F.explode(F.array("a", "b")).alias("id")).distinct(), "spread")
    sketches = scratch.written(texts.join(members.select("id").distinct(), "id", "left_semi").select("id", "line").mapInArrow(_sketch, "id long, n long, bits array<long>, keys array<long>"), "sketches")
    roots = further.linked(members, sketches, roots, pairs, confirmed, percent, PARITY)
    scratch.dropped(stars, pairs, texts, open_, members, sketches)
    return lines, roots


def _distinct_ids(lines: DataFrame) -> DataFrame:
    """Ids are 64 bits of the 128-bit digests; lines that differ but share an id get other ids, until none do."""
    for salt in range(1, 9):
        clash = lines.groupBy("id").agg(F.min("more").alias("lo"), F.max("more").alias("hi")).where("lo <> hi").select("id")
        clash = scratch.written(clash, "clash")
        if clash.isEmpty():
            return lines
        again = lines.join(clash.withColumn("clash", F.lit(True)), "id", "left")
        lines = again.withColumn("id", F.when(F.col("clash"), F.xxhash64("id", "more", F.lit(salt))).otherwise(F.col("id"))).drop("clash")
    raise RuntimeError("ids of lines still clash")
