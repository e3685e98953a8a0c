"""SentencePiece encoding that keeps source offsets, and decoding.

A text is normalised by longest-prefix matches in the model's compiled character map; every byte that comes out carries the
source position it came from.  Pieces are found on the normalised text, and their ends are projected through that alignment
to byte spans of the original text, which tile it.

Where no piece has anything before a space mark, BPE never merges over a word's start; texts are then cut into words, and a
bounded cache in each worker keeps what a word becomes.  Decoding needs only the table of pieces.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch

MARK = "▁"
#: Words that a worker's cache holds, in each of two generations; longer words (characters) are never held, so its bytes are bounded.
CACHE, LONGEST = 200_000, 64
_UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class CharsMap:
    """The compiled character map: a double-array trie over UTF-8 bytes whose values point at NUL-ended replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, int]:
        """(length, value) of the longest key that ``text`` has at ``at``; length 0 where there is none."""
        best, value, units = 0, 0, self.units
        if not units:
            return best, value
        unit = units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                best, value = i - at + 1, units[node] & 0x7FFFFFFF
        return best, value

    def replacement(self, value: int) -> bytes:
        return self.replacements[value : self.replacements.index(b"\0", value)]


def _width(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Codec:
    """``proto``: the bytes of a .model file."""

    def __init__(self, proto: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto.FromString(proto)
        spec, kinds = model.normalizer_spec, model.trainer_spec
        self.map = CharsMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = kinds.treat_whitespace_as_suffix
        self.user = sorted((p.piece.encode() for p in model.pieces if p.type == p.USER_DEFINED), key=len, reverse=True)
        self.fallback = kinds.byte_fallback
        self.eos, self.unk = -1, -1
        self.surface: list[bytes] = []
        self.is_byte = np.zeros(len(model.pieces), bool)
        for i, p in enumerate(model.pieces):
            if p.type == p.BYTE:
                self.is_byte[i] = True
                self.surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == p.UNKNOWN:
                self.unk = i
                self.surface.append(kinds.unk_surface.encode())
            else:
                self.surface.append(b"" if p.type == p.CONTROL else p.piece.replace(MARK, " ").encode())
            if p.type == p.CONTROL and p.piece == (kinds.eos_piece or "</s>"):
                self.eos = i
        self.marked = [p.piece.startswith(MARK) for p in model.pieces]
        self.size = [1 if b else len(p.piece.encode()) for b, p in zip(self.is_byte, model.pieces, strict=True)]
        self.sizes, self.widths, self.names = np.array(self.size, "<u2"), np.array([len(x) for x in self.surface], np.int64), [str(i) for i in range(len(self.size))]
        ordinary = [p.piece for p in model.pieces if p.type == p.NORMAL]
        self.by_word = self.fallback and self.escape and not self.suffix and not self.user and not any(MARK in p.lstrip(MARK) for p in ordinary)
        self.plain = self.by_word and not self.map.units and not self.squeeze and self.prefix
        self.by_line = self.plain and not any("\n" in p for p in ordinary)
        inner = pb.ModelProto.FromString(proto)
        inner.normalizer_spec.precompiled_charsmap = b""
        inner.normalizer_spec.add_dummy_prefix = inner.normalizer_spec.remove_extra_whitespaces = inner.normalizer_spec.escape_whitespaces = False
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=inner.SerializeToString())
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.packed: dict[str, bytes] = {}
        self.packed_old: dict[str, bytes] = {}

    # -- normalisation with alignment -------------------------------------------------------------------------------------
    def _prefix_at(self, text: bytes, at: int) -> tuple[bytes, int]:
        for u in self.user:
            if text.startswith(u, at):
                return u, len(u)
        n, value = self.map.longest(text, at)
        if n:
            return self.map.replacement(value), n
        n = _width(text[at])
        return text[at : at + n], n

    def normalise(self, text: str) -> tuple[bytes, list[int]]:
        """The normalised bytes and, for each byte and for the end, the source byte it came from."""
        source, out, origin, at = text.encode(), bytearray(), [], 0
        if self.squeeze:
            while at < len(source):
                piece, n = self._prefix_at(source, at)
                if piece != b" ":
                    break
                at += n
        if at >= len(source):
            return b"", [at]
        mark = MARK.encode() if self.escape else b" "

        def put(data: bytes) -> None:
            out.extend(data)
            origin.extend([at] * len(data))

        if self.prefix and not self.suffix:
            put(mark)
        spaced = self.squeeze
        while at < len(source):
            piece, n = self._prefix_at(source, at)
            if spaced:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", mark))
                spaced = piece.endswith(b" ")
            at += n
            if not self.squeeze:
                spaced = False
        if self.squeeze:
            while out.endswith(mark):
                at = origin[len(out) - len(mark)]
                del out[-len(mark) :], origin[-len(mark) :]
        if self.prefix and self.suffix:
            put(mark)
        origin.append(at)
        return bytes(out), origin

    # -- pieces -----------------------------------------------------------------------------------------------------------
    def _made(self, units: list[str]) -> list[tuple[list[int], list[int]]]:
        """Piece ids and lengths in normalised bytes of normalised units."""
        out = []
        for unit, ids in zip(units, self.pieces.encode(units, num_threads=1), strict=True):
            if self.unk in ids:
                lengths = [1 if self.is_byte[i] else len(p.encode()) for i, p in zip(ids, self.pieces.encode(unit, out_type=str), strict=True)]
            else:
                lengths = [self.size[i] for i in ids]
            out.append((ids, lengths))
        return out

    def _learn(self, words: list[str]) -> dict[str, tuple]:
        """word -> ids and source lengths as bytes, ids as text, what they decode to."""
        made = self.pieces.encode([w if w[:1] == "\n" else MARK + w for w in words], num_threads=1)
        flat = [i for ids in made for i in ids]
        at = np.cumsum([0, *map(len, made)])
        array = np.array(flat, "<i4")
        lengths = self.sizes[array]
        lengths[at[:-1][[w[:1] != "\n" for w in words]]] -= 2  # the mark stands for one space, not three bytes
        packed, sizes, names = array.tobytes(), lengths.tobytes(), [self.names[i] for i in flat]
        surfaces = b"".join([self.surface[i] for i in flat])
        ends = np.concatenate([[0], np.cumsum(self.widths[array])])[at].tolist()
        at = at.tolist()
        return {w: (packed[4 * i : 4 * j], sizes[2 * i : 2 * j], " ".join(names[i:j]), surfaces[p:q].decode("utf-8", "replace")) for w, i, j, p, q in zip(words, at, at[1:], ends, ends[1:], strict=False)}

    def _fast(self, text: str) -> list[str] | None:
        """The text's words, or None where they can't be cut at single spaces (and before line ends)."""
        if not self.plain or not text:
            return None
        if self.by_line:
            text = text.replace("\n", " \n")
        if "  " in text or text[0] == " " or MARK in text or (not self.by_line and "\n" in text):
            return None
        return text.split(" ")

    def _entries(self, words: list[str]) -> list[tuple]:
        young = self.young
        got = list(map(young.get, words))
        if None not in got:
            return got
        at = [i for i, g in enumerate(got) if g is None]
        new = {words[i] for i in at}
        own = {w: g for w in new if (g := self.old.get(w)) is not None}
        missing = [w for w in new if w not in own]
        for i in range(0, len(missing), 20_000):
            own |= self._learn(missing[i : i + 20_000])
        kept = {w: g for w, g in own.items() if len(w) <= LONGEST}
        if len(young) + len(kept) > CACHE:
            self.old, self.young = young, {}
        self.young.update(kept)
        for i in at:
            got[i] = own[words[i]]
        return got

    def ids(self, text: str | None) -> np.ndarray:
        """Ids alone, without an end id."""
        if (words := self._fast(text or "")) is not None:
            return np.frombuffer(b"".join([g[0] for g in self._entries(words)]), "<i4")
        return self.encode(text)[0]

    def _packed(self, words: list[str]) -> dict[str, bytes]:
        """word -> ids as bytes."""
        made = self.pieces.encode([w if w[:1] == "\n" else MARK + w for w in words], num_threads=1)
        at = np.cumsum([0, *map(len, made)]) * 4
        flat, at = np.fromiter(chain.from_iterable(made), "<i4", int(at[-1]) // 4).tobytes(), at.tolist()
        return {w: flat[i:j] for w, i, j in zip(words, at, at[1:], strict=False)}

    def ids_of(self, texts: list[str | None]) -> list[np.ndarray]:
        """:meth:`ids` of each text.  New words are learnt for all texts at once, and nothing but ids is kept of a word."""
        cut = [self._fast(t or "") for t in texts]
        new = set().union(*(c for c in cut if c is not None)).difference(self.packed)
        own = {w: g for w in new if (g := self.packed_old.get(w)) is not None}
        missing = [w for w in new if w not in own]
        for i in range(0, len(missing), 20_000):
            own |= self._packed(missing[i : i + 20_000])
        self.packed |= own
        out = [self.encode(t)[0] if c is None else np.frombuffer(b"".join(map(self.packed.__getitem__, c)), "<i4") for t, c in zip(texts, cut, strict=True)]
        for w in own:
            if len(w) > LONGEST:
                del self.packed[w]
        if len(self.packed) > CACHE:
            self.packed_old, self.packed = self.packed, {}
        return out

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids without an end id, and the start and end bytes of each piece in the UTF-8 of ``text``."""
        text = text or ""
        if (words := self._fast(text)) is not None:
            got = self._entries(words)
            ids = np.frombuffer(b"".join([g[0] for g in got]), "<i4")
            ends = np.cumsum(np.frombuffer(b"".join([g[1] for g in got]), "<u2"), dtype=np.int64) - 1
            ends = np.maximum(ends, 0)
            return ids, np.concatenate([[0], ends[:-1]]), ends
        norm, origin = self.normalise(text)
        string = norm.decode("utf-8", "replace")
        units = _UNITS.findall(string) if self.by_word else [string] if string else []
        made = self._made(units)
        ids = np.array([i for m in made for i in m[0]], np.int32)
        ends = np.cumsum([n for m in made for n in m[1]], dtype=np.int64)
        origin = np.array(origin, np.int64)
        ends = origin[ends] if len(ends) else ends
        starts = np.concatenate([origin[:1], ends[:-1]]) if len(ends) else ends
        return ids, starts, ends

    def decode(self, ids) -> str:
        """What the library's decode gives: marks become spaces, byte pieces join to UTF-8, the dummy prefix goes."""
        data, start = [], self.prefix or self.squeeze
        for i in ids:
            piece = self.surface[i]
            if start and piece:
                if self.marked[i]:
                    piece = piece[1:]
                start = self.squeeze and not piece
            data.append(piece)
        return b"".join(data).decode("utf-8", "replace")

    def digests(self, text: str | None) -> tuple[int, str, str, bool]:
        """(tokens with the end id, SHA-256 of the ids, SHA-256 of the decoded text, whether the spans tile the source)."""
        text = text or ""
        end = str(self.eos)
        if (words := self._fast(text)) is not None:
            packed, lengths, names, back = zip(*self._entries(words), strict=True)
            n = sum(map(len, packed)) // 4
            ends = np.cumsum(np.frombuffer(b"".join(lengths), "<u2"), dtype=np.int64) - 1
            tiled = int(ends[-1]) == len(text.encode())
            ids, back = f"{' '.join(names)} {end}", "".join(back)[1:]
        else:
            array, starts, ends = self.encode(text)
            n, source = len(array), text.encode()
            tiled = bool(n == 0 or (starts[1:] == ends[:-1]).all() and ends[-1] <= len(source))
            ids, back = " ".join(map(str, [*array.tolist(), end])), self.decode(array.tolist())
        return n + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), tiled


def read_model(spark: SparkSession, path: str) -> bytes:
    """A model file (a few MB at most), by any path that Spark reads; a plain path is read on the driver."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def codec(proto: bytes) -> Codec:
    return Codec(proto)


def _over(docs: DataFrame, proto: bytes, schema: str, make: Callable[[Codec, list], list[pa.Array]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                ids, texts = batch.column(0).slice(i, 128), batch.column(1).slice(i, 128)
                yield pa.RecordBatch.from_arrays([ids, *make(own, texts.to_pylist())], [x.split()[0] for x in schema.split(", ")])

    return scratch.passed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)


def encoded(docs: DataFrame, proto: bytes) -> DataFrame:
    """doc_id, ids, starts, ends: the pieces of each whole text (no end id) and their byte spans in it; null is empty."""

    def make(own: Codec, texts: list) -> list[pa.Array]:
        got = [own.encode(t) for t in texts]
        return [pa.array([g[k].tolist() for g in got], pa.list_(kind)) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]

    return _over(docs, proto, "doc_id long, ids array<int>, starts array<long>, ends array<long>", make)


def decoded(rows: DataFrame, proto: bytes) -> DataFrame:
    """doc_id, text from rows of doc_id, ids."""
    shared = rows.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digested(docs: DataFrame, proto: bytes) -> DataFrame:
    """doc_id, n_tokens (with the end id), ids_sha256, decoded_sha256, spans_tile for each row of ``docs``.

    Digests are made where the pieces are, so pieces never leave the worker.  A null text is an empty one; repeated rows each
    have a row; long texts are encoded whole; an empty table gives an empty result.
    """

    def make(own: Codec, texts: list) -> list[pa.Array]:
        got = list(zip(*(own.digests(t) for t in texts), strict=True)) or [()] * 4
        return [pa.array(x, kind) for x, kind in zip(got, (pa.int64(), pa.string(), pa.string(), pa.bool_()), strict=True)]

    return _over(docs, proto, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_tile boolean", make)
