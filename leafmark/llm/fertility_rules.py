"""Quality rules by tokeniser fertility.

Two public vocabularies measure each whole text: one of pieces with byte fallback, and one of bytes for many languages.  Both
give tokens per word (fertility) and characters per token; the first also gives the share of byte-fallback tokens and the
entropy of its tokens: Shannon's, as a part of what its length allows, and min-entropy (of the commonest token).  Bands for each
language, or else the script of most of the text's letters, reject what lies outside for either vocabulary.  Counts of words,
symbols, repeated lines and repeated word windows come with it and reject by themselves what is too short or repeats itself.
One pass over the rows, which do not move; the vocabularies (about a MB) are broadcast.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from . import scratch
from .sentencepiece_codec import codec

WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
#: Part of the measure: the token entropy of a language is bounded, so what a length allows stops growing at log2 of this many tokens.
_ENTROPY_TOKENS = 3000


@dataclass(frozen=True)
class Band:
    """Bounds for the piece vocabulary, then those of tokens per word and characters per token for the byte vocabulary."""

    tokens_per_word: tuple[float, float]
    chars_per_token: tuple[float, float]
    byte_share: float
    entropy: float
    min_entropy: float
    other_per_word: tuple[float, float]
    other_chars: tuple[float, float]


#: Fixed values, by language, then by script for other languages.
BANDS = {
    "en": Band((1.0, 3.4), (2.0, 5.5), 0.08, 0.57, 3.1, (1.0, 3.6), (2.0, 6.0)),
    "de": Band((1.0, 3.5), (1.9, 5.5), 0.08, 0.57, 3.1, (1.0, 3.6), (2.0, 6.0)),
    "fr": Band((1.0, 3.75), (1.8, 5.5), 0.08, 0.57, 3.1, (1.0, 3.9), (1.9, 6.0)),
    "es": Band((1.0, 3.75), (1.8, 5.5), 0.08, 0.57, 3.1, (1.0, 3.9), (1.9, 6.0)),
    "latin": Band((1.0, 4.0), (1.5, 6.0), 0.12, 0.55, 3.0, (1.0, 4.2), (1.5, 7.0)),
    "greek": Band((1.0, 10.0), (0.7, 4.0), 0.3, 0.45, 2.0, (1.0, 6.0), (1.2, 5.0)),
    "cyrillic": Band((1.0, 8.0), (0.8, 4.5), 0.3, 0.45, 2.0, (1.0, 5.0), (1.5, 6.0)),
    "hebrew": Band((1.0, 10.0), (0.7, 4.0), 0.3, 0.45, 2.0, (1.0, 6.0), (1.2, 5.0)),
    "arabic": Band((1.0, 10.0), (0.7, 4.0), 0.3, 0.45, 2.0, (1.0, 6.0), (1.2, 5.0)),
    "indic": Band((1.0, 14.0), (0.4, 3.0), 0.7, 0.4, 1.7, (1.0, 12.0), (0.4, 4.0)),
    "other": Band((1.0, 1e9), (0.25, 6.0), 1.0, 0.4, 1.7, (1.0, 1e9), (0.25, 6.0)),
}
#: First code points of blocks and their scripts; empty: no letters.
_BLOCKS = [(0x00, ""), (0x41, "latin"), (0x5B, ""), (0x61, "latin"), (0x7B, ""), (0xC0, "latin"), (0x250, ""), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"),
           (0x900, "indic"), (0xE00, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x2C00, "other"), (0x3000, ""), (0x3040, "other"), (0xE000, ""), (0xF900, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, ""), (0xFE70, "arabic"), (0xFF00, ""), (0x20000, "other")]
_FIRST, _NAMES = np.array([at for at, _ in _BLOCKS]), sorted({name for _, name in _BLOCKS})
_NAME_OF = np.array([_NAMES.index(name) for _, name in _BLOCKS])


def script_of(text: str) -> str:
    """The script of most letters; 'other' without any."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    counts = np.bincount(_NAME_OF[np.searchsorted(_FIRST, points, "right") - 1], minlength=len(_NAMES))
    counts[_NAMES.index("")] = 0
    return _NAMES[int(counts.argmax())] if counts.any() else "other"


def band_of(lang: str | None, text: str) -> Band:
    """The language's band, else that of the text's script."""
    return BANDS.get(lang or "") or BANDS[script_of(text)]


class ByteVocabulary:
    """Token counts of a byte-level BPE, from a file of base64 tokens and ranks."""

    #: Runs without white space are merged in time that grows with their square, so longer ones are counted in parts.
    RUN = 4096
    _LONG = re.compile(rf"\S{{{RUN}}}")

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def count(self, text: str) -> int:
        if self._LONG.search(text):
            return sum(len(self.encoding.encode_ordinary(text[i : i + self.RUN])) for i in range(0, len(text), self.RUN))
        return len(self.encoding.encode_ordinary(text))


@lru_cache(maxsize=2)
def byte_vocabulary(ranks: bytes, pattern: str) -> ByteVocabulary:
    return ByteVocabulary(ranks, pattern)


def base_counts(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by document."""
    docs = len(offsets) - 1
    s, e, d = B.words(buf, offsets)
    n_words = np.bincount(d, minlength=docs)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    chars = per_doc(((buf & 0xC0) != 0x80) & ~B.SPACE[buf])
    symbols = per_doc(_SYMBOL[buf])
    sums = B.prefix(buf)

    dup_lines = np.zeros(docs, np.int64)
    ls, le, ld = B.spans(buf != 10, offsets)
    if len(ls):
        within = np.searchsorted(s, le) - np.searchsorted(s, ls)
        ls, le, ld = ls[within > 0], le[within > 0], ld[within > 0]
        h = B.span_hash(sums, ls, le)
        order = np.lexsort((le - ls, h, ld))
        same = (h[order][1:] == h[order][:-1]) & (ld[order][1:] == ld[order][:-1]) & ((le - ls)[order][1:] == (le - ls)[order][:-1])
        dup_lines = np.bincount(ld[order][1:][same], minlength=docs)

    repeats = np.zeros(docs, np.int64)
    if len(s):
        h, first = B.runs(B.span_hash(sums, s, e), WINDOW, d)
        order = np.lexsort((h, d[first]))
        ho, do = h[order], d[first][order]
        same = (ho[1:] == ho[:-1]) & (do[1:] == do[:-1])
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        step = np.zeros(len(s) + 1, np.int64)
        np.add.at(step, first[twice], 1)
        np.add.at(step, first[twice] + WINDOW, -1)
        repeats = np.bincount(d[np.cumsum(step)[:-1] > 0], minlength=docs)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeats}


def measures(pieces, other: ByteVocabulary, text: str, n_words: int, ids: np.ndarray | None = None) -> tuple[int, float, float, float, float, float, float, float]:
    """n_tokens, tokens per word, characters per token, byte share, entropy share, min-entropy; then tokens per word and characters
    per token of the byte vocabulary.  ``ids``: the text's pieces, if known."""
    ids = pieces.ids(text) if ids is None else ids
    n = len(ids)
    if n == 0:
        return 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0
    counts = np.bincount(ids)
    p = counts[counts > 0] / n
    entropy = float(-(p * np.log2(p)).sum()) / max(np.log2(min(n, _ENTROPY_TOKENS)), 1.0)
    m = other.count(text)
    return n, n / max(n_words, 1), len(text) / n, float(pieces.is_byte[ids].mean()), entropy, float(-np.log2(p.max())), m / max(n_words, 1), len(text) / max(m, 1)


def verdict(band: Band, m: tuple) -> bool:
    _, per_word, per_token, byte_share, entropy, least, other_word, other_token = m
    bounds = zip((band.tokens_per_word, band.chars_per_token, band.other_per_word, band.other_chars), (per_word, per_token, other_word, other_token), strict=True)
    return all(low <= x <= high for (low, high), x in bounds) and byte_share <= band.byte_share and entropy >= band.entropy and least >= band.min_entropy


_MEASURES = ["n_tokens", "tokens_per_word", "chars_per_token", "byte_share", "entropy_share", "min_entropy", "other_per_word", "other_chars"]


def rules(docs: DataFrame, proto: bytes, ranks: bytes, pattern: str) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang): the base counts, base_failed, the measures and kept.

    ``proto``: a SentencePiece model with byte fallback; ``ranks`` and ``pattern``: a byte-level BPE.
    base_failed: under 20 words, or over 30 % of the words in repeated 8-word windows.  A null text has no words and fails.
    A null or unknown language has its script's band.  Repeated rows each have a row; an empty table gives an empty result;
    texts of any length are measured whole.  Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((proto, ranks, pattern))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = ["doc_id", *counts, "base_failed", "kept", *_MEASURES]
    schema = ", ".join(["doc_id long", *(f"{k} long" for k in counts), "base_failed boolean", "kept boolean", "n_tokens long", *(f"{k} double" for k in _MEASURES[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, *vocabulary = shared.value
        pieces, other = codec(model), byte_vocabulary(*vocabulary)
        for batch in batches:
            for lo, hi, buf, offsets in B.chunks(batch.column(1)):
                base = base_counts(buf, offsets)
                failed = (base["n_words"] < 20) | (100 * base["n_repeat_words"] > 30 * base["n_words"])
                texts, langs = batch.column(1).slice(lo, hi - lo).to_pylist(), batch.column(2).slice(lo, hi - lo).to_pylist()
                got = [measures(pieces, other, t or "", int(n), ids) for t, n, ids in zip(texts, base["n_words"], pieces.ids_of(texts), strict=True)]
                kept = [not bad and verdict(band_of(lang, t or ""), m) for bad, lang, t, m in zip(failed, langs, texts, got, strict=True)]
                columns = [pa.array(base[k].astype(np.int64)) for k in counts] + [pa.array(failed), pa.array(kept, pa.bool_())]
                columns += [pa.array([m[k] for m in got], pa.float64() if k else pa.int64()) for k in range(len(_MEASURES))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], names)

    return scratch.passed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")), run, schema)
