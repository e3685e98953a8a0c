"""Vectorised text kernels over Arrow string buffers: words, lines, shingles and their 64-bit hashes, no Python strings.

A chunk is the UTF-8 bytes of whole documents, one after another, with their offsets.
Hashes are polynomials modulo 2**64 taken from one prefix sum, so that any span costs O(1), then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U(pow(int(_BASE), -1, 1 << 64))
_pow: dict[str, np.ndarray] = {}

#: The white space of every contract: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                table = np.empty(size, U)
                table[0], done, step = 1, 1, base
                while done < size:
                    table[done : 2 * done] = table[:done] * step
                    done, step = 2 * done, step * step
                _pow[name] = table
    return _pow["up"], _pow["down"]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """The splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = x + U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def chunks(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, bytes, offsets) of about ``limit`` bytes; a longer document comes alone.  Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def prefix(buf: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: entry i is that of the first i bytes."""
    up, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum((buf.astype(U) + U(1)) * up[: len(buf)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * down[starts])


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true positions that do not cross documents: starts, ends, and the document of each."""
    n = len(inside)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    cuts = offsets[:-1]
    cuts = cuts[cuts < n]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return spans(~SPACE[buf], offsets)


def characters(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the offsets of the documents in them."""
    lead = (buf & 0xC0) != 0x80
    if lead.all():
        return buf.astype(np.uint32), offsets
    at = np.flatnonzero(lead)
    more = np.concatenate([buf, np.zeros(3, np.uint8)])
    b0, b1, b2, b3 = (more[at + k].astype(np.uint32) for k in range(4))
    low = np.uint32(0x3F)
    two = (b0 & np.uint32(0x1F)) << np.uint32(6) | b1 & low
    three = (b0 & np.uint32(0x0F)) << np.uint32(12) | (b1 & low) << np.uint32(6) | b2 & low
    four = (b0 & np.uint32(0x07)) << np.uint32(18) | (b1 & low) << np.uint32(12) | (b2 & low) << np.uint32(6) | b3 & low
    points = np.where(b0 < 0x80, b0, np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four)))
    return points, np.concatenate([[0], np.cumsum(lead)])[offsets]


def runs(values: np.ndarray, size: int, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` neighbouring values of one document, and the index of each run's first value."""
    m = len(values) - size + 1
    if m <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    first = np.flatnonzero(doc[:m] == doc[size - 1 :])
    out = np.zeros(len(first), U)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * U(0xD6E8FEB86659FD93) + values[first + k]
    return mix(out, 7), first


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word-shingle hashes by document, sorted: (hashes, document of each, number by document).

    A-Z are lower-cased.  A document with fewer words than ``size`` has its whole sequence as one shingle; without words, none.
    """
    docs = len(offsets) - 1
    buf = LOWER[buf]
    s, e, d = words(buf, offsets)
    h = span_hash(prefix(buf), s, e)
    sh, first = runs(h, size, d)
    owner = d[first]
    count = np.bincount(d, minlength=docs)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        begin = np.searchsorted(d, short)
        whole = np.zeros(len(short), U)
        with np.errstate(over="ignore"):
            for k in range(size - 1):
                more = k < count[short]
                whole[more] = whole[more] * U(0xD6E8FEB86659FD93) + h[begin[more] + k]
        sh, owner = np.concatenate([sh, mix(whole, 11)]), np.concatenate([owner, short])
    order = np.lexsort((sh, owner))
    sh, owner = sh[order], owner[order]
    fresh = np.ones(len(sh), bool)
    fresh[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    sh, owner = sh[fresh], owner[fresh]
    return sh, owner, np.bincount(owner, minlength=docs)
