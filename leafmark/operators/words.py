"""Words of texts, cut in Arrow batches: the same as functions.text.words, which costs some ten times as much.

Texts of characters below U+0300 (no cluster has two of them) are normalised and cut here; the JVM does the others.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X

_SPACES, _MARKS = re.compile("[ \t\n\x0b\f\r]+"), str.maketrans({**{c: None for c in X.DROPPED}, **dict(zip(X.QUOTES_FROM, X.QUOTES_TO, strict=True))})


def wide(c: Column) -> Column:
    """Whether a text has characters that only the JVM's rules deal with."""
    return F.coalesce(c.rlike(r"[^\x00-˿]"), F.lit(False))


def normalised(text: str | None) -> str:
    """``functions.text.normalise`` of a text that is not wide."""
    return _SPACES.sub(" ", (text or "").translate(_MARKS)).strip(" ")


def cut(norm: str) -> list[str]:
    """Tokens of a normalised text without punctuation around them."""
    return [w for x in norm.split(" ") if (w := x.strip(X.PUNCTUATION))]


def words(c: Column) -> Column:
    @F.arrow_udf("array<string>")
    def run(texts: pa.Array, whole: pa.Array) -> pa.Array:
        return pa.array([w if w is not None else cut(normalised(t)) for t, w in zip(texts.to_pylist(), whole.to_pylist(), strict=True)], pa.list_(pa.string()))

    return run(c, F.when(wide(c), X.words(c)))


def agreed(readings: Column) -> Column:
    """The distinct words that two or more of a line's readings have."""

    @F.arrow_udf("array<string>")
    def run(lines: pa.Array, whole: pa.Array) -> pa.Array:
        out = []
        for texts, others in zip(lines.to_pylist(), whole.to_pylist(), strict=True):
            seen: set[str] = set()
            twice: set[str] = set()
            for k, t in enumerate(texts or []):
                own = set(others[k] if others[k] is not None else cut(normalised(t)))
                twice |= own & seen
                seen |= own
            out.append(list(twice))
        return pa.array(out, pa.list_(pa.string()))

    return run(readings, F.transform(readings, lambda t: F.when(wide(t), X.words(t))))
