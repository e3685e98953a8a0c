"""Rows of a page brought together as packed columns.

A page's words or symbols are small rows by the thousand.  What a partition has of a page is packed (differences, zstd) before the
shuffle, and whole pages are handed on, many at once, as Arrow columns; so neither the shuffle nor Python pays for each row.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Rows of whole pages that are worked on at once; a longer page goes alone.
ROWS = 1 << 17


def _ints(v: np.ndarray) -> bytes:
    """Differences in the fewest bytes that hold them all; those of 64-bit numbers wrap, and come back by wrapping again."""
    d = np.diff(v.astype(np.int64), prepend=np.int64(0))
    for kind in (np.int8, np.int16, np.int32):
        if not len(d) or np.iinfo(kind).min <= d.min() and d.max() <= np.iinfo(kind).max:
            return np.dtype(kind).char.encode() + d.astype(kind).tobytes()
    return b"q" + d.tobytes()


def _unints(b: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(b, np.dtype(chr(b[0])), offset=1), dtype=np.int64)


def _column(c: pa.Array) -> list[bytes]:
    """Validity (empty: all there) and values of a column of whole numbers, booleans, doubles or strings."""
    valid = np.packbits(pc.is_valid(c).to_numpy(zero_copy_only=False)).tobytes() if c.null_count else b""
    if pa.types.is_string(c.type):
        c = c.fill_null("") if valid else c
        lengths = pc.binary_length(c).to_numpy()
        at = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1] if len(c) else np.zeros(1, np.int32)
        return [valid, _ints(lengths), bytes(memoryview(c.buffers()[2])[at[0] : at[-1]]) if at[-1] > at[0] else b""]
    v = (c.fill_null(False if pa.types.is_boolean(c.type) else 0) if valid else c).to_numpy(zero_copy_only=False)
    if v.dtype.kind != "f":
        return [valid, _ints(v)]
    whole = np.abs(v) < 2**53  # false for what is no number
    if whole.all() and (v == np.rint(v)).all() and not (np.signbit(v) & (v == 0)).any():
        return [valid, _ints(v.astype(np.int64))]
    return [valid, b"d" + v.astype(np.float64).tobytes()]


def _packed(batch: pa.RecordBatch) -> bytes:
    parts = [p for c in batch.columns for p in _column(c)]
    body = struct.pack(f"<{len(parts) + 2}q", len(batch), len(parts), *map(len, parts)) + b"".join(parts)
    return struct.pack("<q", len(body)) + pa.compress(body, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, kinds: list[pa.DataType]) -> pa.RecordBatch:
    body = pa.decompress(memoryview(blob)[8:], struct.unpack_from("<q", blob)[0], codec="zstd", asbytes=True)
    n, count = struct.unpack_from("<2q", body)
    at, parts = 16 + 8 * count, []
    for size in struct.unpack_from(f"<{count}q", body, 16):
        parts.append(body[at : at + size])
        at += size
    own, out = iter(parts), []
    for kind in kinds:
        valid = next(own)
        gone = ~np.unpackbits(np.frombuffer(valid, np.uint8), count=n).astype(bool) if valid else None
        first = next(own)
        if pa.types.is_string(kind):
            ends = np.zeros(n + 1, np.int32)
            np.cumsum(_unints(first), out=ends[1:])
            c = pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(next(own)))
            out.append(pc.if_else(pa.array(gone), pa.scalar(None, kind), c) if gone is not None else c)
            continue
        v = np.frombuffer(first, np.float64, offset=1) if first[:1] == b"d" else _unints(first)
        out.append(pa.array(v.astype(kind.to_pandas_dtype()), kind, mask=gone))
    return pa.RecordBatch.from_arrays(out, [f"c{i}" for i in range(len(kinds))])


def _breaks(keys: list[pa.Array]) -> np.ndarray:
    """Where a row's keys differ from those of the row before."""
    new = np.zeros(max(len(keys[0]) - 1, 0), bool)
    for k in keys:
        codes = pc.fill_null(pc.dictionary_encode(k).indices, -1).to_numpy(zero_copy_only=False)
        new |= codes[1:] != codes[:-1]
    return np.flatnonzero(new) + 1


def by_page(rows: DataFrame, page: list[str], work: Callable[[pa.Table, np.ndarray], tuple[np.ndarray, list]], schema: str) -> DataFrame:
    """``work(columns, bounds)`` on whole pages: page k has rows bounds[k] .. bounds[k + 1] of the columns that are no keys, in any order.

    It returns the page number of each row of its result and the result's columns, those of ``schema``; the keys are put before them.
    ``rows`` may hold one array of structs besides the keys; its elements are the rows then.
    """
    nested = any(t.startswith("array<struct<") for _, t in rows.dtypes)
    flat = rows.selectExpr(*page, f"inline({next(c for c in rows.columns if c not in page)})") if nested else rows  # for its types
    values = [c for c in flat.columns if c not in page]
    kinds_of = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}
    kinds = [kinds_of[t] for c, t in flat.select(*values).dtypes]
    keys = ", ".join(f"{k} {t}" for k, t in rows.select(*page).dtypes)
    m = len(page)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                starts = np.concatenate([[0], _breaks(b.columns[:m])])
                bounds = np.append(starts, len(b))
                columns = b.columns[m:]
                if nested:
                    lengths = pc.fill_null(pc.list_value_length(columns[0]), 0).to_numpy(zero_copy_only=False)
                    bounds, columns = np.concatenate([[0], np.cumsum(lengths)])[bounds], columns[0].flatten().flatten()
                blobs = [_packed(pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in columns], values)) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                sizes = pa.array(np.diff(bounds).astype(np.int64))
                got = pa.RecordBatch.from_arrays([*(c.take(pa.array(starts)) for c in b.columns[:m]), sizes, pa.array(blobs, pa.binary())], [*page, "packed_n", "packed"])
                yield got.filter(pc.greater(sizes, 0)) if nested else got

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole pages, sorted by their keys."""
        own = pa.Table.from_batches(held).combine_chunks()
        heads = [c.chunk(0) for c in own.columns[:m]]
        first = np.concatenate([[0], _breaks(heads)])
        before = np.concatenate([[0], np.cumsum(own.column(m).to_numpy())])
        columns = pa.Table.from_batches([_unpacked(x.as_py(), kinds) for x in own.column(m + 1)]).combine_chunks().rename_columns(values)
        number, result = work(columns, np.concatenate([before[first], before[-1:]]))
        if len(number):
            yield pa.RecordBatch.from_arrays([*(h.take(pa.array(first[number])) for h in heads), *(x if isinstance(x, pa.Array) else pa.array(x) for x in result)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if not len(b):
                continue
            for part in (b.slice(i, 64) for i in range(0, len(b), 64)):
                held, size = [*held, part], size + pc.sum(part.column(m)).as_py()
                if size >= ROWS:
                    whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    last = _breaks(whole.columns[:m])
                    if len(last):  # the last page may go on
                        yield from done([whole.slice(0, int(last[-1]))])
                        held = [whole.slice(int(last[-1]))]
                        size = pc.sum(held[0].column(m)).as_py()
        if held:
            yield from done(held)

    names = [*page, *(x.split()[0] for x in schema.split(", "))]
    packed = rows.select(*page, *(c for c in rows.columns if c not in page)).mapInArrow(pack, f"{keys}, packed_n long, packed binary")
    # a fixed number: packed rows are few bytes but much work, so they must not be gathered by size
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.repartition(tasks, *page).sortWithinPartitions(*page).mapInArrow(run, f"{keys}, {schema}")


def ordered(columns: list[np.ndarray]) -> np.ndarray | None:
    """The stable order by these columns, the first one first; None where rows lie so already."""
    tie, wrong = np.ones(max(len(columns[0]) - 1, 0), bool), np.zeros(max(len(columns[0]) - 1, 0), bool)
    for c in columns:
        wrong |= tie & (c[1:] < c[:-1])
        tie &= c[1:] == c[:-1]
    return np.lexsort(columns[::-1]) if wrong.any() else None


def keyed(c: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """Columns that sort as ``c`` does, nulls first; strings by their bytes."""
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    if pa.types.is_string(c.type):
        d = pc.dictionary_encode(c)
        rank = np.argsort(np.array([x.encode() for x in d.dictionary.to_pylist()] or [b""], object), kind="stable")
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        codes = pc.fill_null(d.indices, -1).to_numpy(zero_copy_only=False)
        return [np.where(codes < 0, -1, place[np.maximum(codes, 0)])]
    if not c.null_count:
        return [c.to_numpy(zero_copy_only=False)]
    return [pc.is_valid(c).to_numpy(zero_copy_only=False), pc.fill_null(c, 0).to_numpy(zero_copy_only=False)]


def extreme(c: pa.Array | pa.ChunkedArray, starts: np.ndarray, low: bool) -> pa.Array:
    """The least (or greatest) value of each run of rows that begins at ``starts``; nulls don't count."""
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    of = np.minimum if low else np.maximum
    if not c.null_count:
        return pa.array(of.reduceat(c.to_numpy(zero_copy_only=False), starts), c.type)
    v, there = pc.fill_null(c, 0).to_numpy(zero_copy_only=False), pc.is_valid(c).to_numpy(zero_copy_only=False)
    most = np.iinfo(v.dtype) if v.dtype.kind == "i" else np.finfo(v.dtype)
    return pa.array(of.reduceat(np.where(there, v, most.max if low else most.min), starts), c.type, mask=~np.logical_or.reduceat(there, starts))
