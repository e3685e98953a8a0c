"""A dictionary's senses under headwords, and corpus texts with fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import squeezed

_RAHAO = "^\\s*ਰਹਾਉ(\\s+ਦੂਜਾ)?\\s*$"


def clean_gurmukhi(c):
    """Segments between dandas that are blank, a counter or the refrain mark go; the rest is joined by spaces."""
    parts = F.filter(F.transform(F.split(c, "[।॥|]"), lambda s: F.trim(s)), lambda s: (s != "") & ~s.rlike("^[੦-੯0-9\\s]+$") & ~s.rlike(_RAHAO))
    return F.array_join(parts, " ")


def dictionary(entries: DataFrame, senses: DataFrame) -> DataFrame:
    """headword, senses array<struct<n,pos,text>>: homographs under one headword, senses numbered anew in the book's order."""
    rows = senses.join(entries, "entry_id")
    w = Window.partitionBy("hw").orderBy("vol", "page", "entry_id", "sense_no", "pos", "text")
    rows = rows.withColumn("n", F.row_number().over(w))
    return rows.groupBy("hw").agg(F.array_sort(F.collect_list(F.struct("n", "pos", "text"))).alias("senses"))


def stem_candidates(word):
    """A word and the word without one inflection of the old language."""
    endings = ["ੁ", "ਿ", "ੀ", "ੈ", "ੋ", "ੇ"]
    return F.array_compact(F.array(word, *[F.when(word.endswith(e) & (F.length(word) > 2), F.substring(word, F.lit(1), F.length(word) - 1)) for e in endings]))


def texts(lines: DataFrame, translations: DataFrame, wanted: list[str]) -> DataFrame:
    """line_id, source, text: the corpus's own text cleaned (its squeezed original where cleaning leaves nothing), and translations.

    A translator without any line is an error that names those there are.
    """
    own = lines.select("line_id", F.lit("own").alias("source"), F.coalesce(F.nullif(clean_gurmukhi(F.col("text")), F.lit("")), squeezed(F.col("text"))).alias("text"))
    other = translations.where(F.col("translator").isin(wanted)).select("line_id", F.col("translator").alias("source"), squeezed(F.col("text")).alias("text")).where("text <> ''")
    asked = translations.where(F.col("translator").isin(wanted))  # no more names than were asked for reach the driver
    if missing := set(wanted) - {"own"} - {r[0] for r in asked.select("translator").distinct().collect()}:
        names = translations.select("translator").distinct().orderBy("translator").take(50)  # of the error's text only
        raise ValueError(f"no lines by {', '.join(sorted(missing))}; known: {', '.join(str(r[0]) for r in names)}")
    return (own if "own" in wanted else own.limit(0)).unionByName(other)


def first_available(texts: DataFrame, order: list[str]) -> DataFrame:
    """line_id, text: the first source in ``order`` that has the line."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("source"))
    return texts.where(rank > 0).groupBy("line_id").agg(F.min_by("text", rank).alias("text"))
