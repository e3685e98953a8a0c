"""Before and after an Indic translation model: digits, entities behind placeholders, one script for all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First code points of scripts laid out alike; Devanagari is the one that models read.
BLOCKS = {"dev": 0x0900, "ben": 0x0980, "pan": 0x0A00, "guj": 0x0A80, "ory": 0x0B00, "tam": 0x0B80, "tel": 0x0C00, "kan": 0x0C80, "mal": 0x0D00}
#: Mail addresses, links, tags and numbers with their marks.
ENTITY = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|(?:https?://|www\.)[^\s]+|[#@][A-Za-z0-9_]+|[0-9][0-9.,:/-]*[0-9]|[0-9]"
#: Punctuation that is written in several ways.
MARKS = {"\r": "", "‐": "-", "‑": "-", "–": "-", "—": " - ", "…": "...", "„": '"', "“": '"', "”": '"', "´´": '"', "‘": "'", "’": "'", "‚": "'", "«": '"', "»": '"', " ": " "}


def moved(c: Column, source: str, target: str) -> Column:
    """Letters of one script as those of another at the same place of their blocks; the two dandas are common to all."""
    a, b = BLOCKS[source], BLOCKS[target]
    places = [k for k in range(0x80) if k not in (0x64, 0x65)]
    return F.translate(c, "".join(chr(a + k) for k in places), "".join(chr(b + k) for k in places))


def ascii_digits(c: Column) -> Column:
    native = "".join(chr(start + 0x66 + d) for start in BLOCKS.values() for d in range(10))
    return F.translate(c, native, "0123456789" * len(BLOCKS))


def plain_marks(c: Column) -> Column:
    for a, b in MARKS.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.regexp_replace(c, r"\s+([.,!?;:%)])", "$1")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def behind_placeholders(c: Column) -> Column:
    """struct(text, entities): each distinct entity of the text stands as <ID1>, <ID2> ..., the longest ones first."""
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0)))
    ordered = F.array_sort(found, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    # numbers inside placeholders must not be replaced again: they are written with letters until all are in
    hidden = F.aggregate(F.transform(ordered, lambda e, i: F.struct(e.alias("e"), i.alias("i"))), c, lambda t, x: F.replace(t, x["e"], F.concat(F.lit("<ID"), F.translate(x["i"].cast("string"), "0123456789", "abcdefghij"), F.lit(">"))))
    shown = F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(ordered) - 1, F.lit(0))), hidden, lambda t, i: F.replace(t, F.concat(F.lit("<ID"), F.translate(i.cast("string"), "0123456789", "abcdefghij"), F.lit(">")), F.concat(F.lit("<ID"), (i + 1).cast("string"), F.lit(">"))))
    return F.struct(shown.alias("text"), ordered.alias("entities"))


def restored(text: Column, entities: Column) -> Column:
    """Entities in place of their placeholders, however a model spaced these."""
    closed = F.regexp_replace(text, r"<\s*[Ii][Dd]\s*([0-9]+)\s*>", "<ID$1>")
    return F.aggregate(F.transform(entities, lambda e, i: F.struct(e.alias("e"), i.alias("i"))), closed, lambda t, x: F.replace(t, F.concat(F.lit("<ID"), (x["i"] + 1).cast("string"), F.lit(">")), x["e"]))


def prepared(c: Column, script: str) -> Column:
    """What a model is shown: struct(text in Devanagari, entities)."""
    p = behind_placeholders(plain_marks(ascii_digits(c)))
    return F.struct(moved(p["text"], script, "dev").alias("text"), p["entities"].alias("entities"))


def finished(c: Column, entities: Column, script: str) -> Column:
    return restored(moved(c, "dev", script), entities)
