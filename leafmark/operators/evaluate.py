"""Error rates, match precision, routing, translation scores and the ingest gate."""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .alignment import distance
from .words import cut, normalised, wide


def error_rates(rows: DataFrame) -> DataFrame:
    """rows: engine, kind, ref, hyp -> by engine and by engine and kind: lines, edits, reference size, word edits and size."""
    one = rows.select("engine", "kind", _compared(F.col("ref"), F.col("hyp")).alias("c")).select("engine", "kind", "c.*")
    sums = [F.count("*").alias("lines"), *(F.sum(c).alias(c) for c in ("edits", "chars", "word_edits", "words"))]
    return one.groupingSets([["engine"], ["engine", "kind"]], "engine", "kind").agg(*sums)


def _compared(ref: Column, hyp: Column) -> Column:
    """struct(edits, chars, word_edits, words) of two texts, in clusters and words of their normalised forms.

    Texts of characters below U+0300 are normalised here, and their clusters are their characters; others come normalised and cut.
    """

    @F.arrow_udf("edits int, chars int, word_edits int, words int")
    def run(refs: pa.Array, hyps: pa.Array, ref_norms: pa.Array, hyp_norms: pa.Array, ref_parts: pa.Array, hyp_parts: pa.Array) -> pa.Array:
        def side(text, norm, parts):
            if norm is None:
                norm = parts = normalised(text)
            return parts, cut(norm)

        out = []
        for a, b, *rest in zip(*(c.to_pylist() for c in (refs, hyps, ref_norms, hyp_norms, ref_parts, hyp_parts)), strict=True):
            (r, rw), (h, hw) = side(a, *rest[::2]), side(b, *rest[1::2])
            if type(r) is not type(h):
                r, h = list(r), list(h)
            out.append((0, len(r), 0, len(rw)) if r == h else (distance(r, h), len(r), 0 if rw == hw else distance(rw, hw), len(rw)))
        return pa.StructArray.from_arrays([pa.array([x[k] for x in out], pa.int32()) for k in range(4)], ["edits", "chars", "word_edits", "words"])

    norms = [F.when(wide(c), X.normalise(c)) for c in (ref, hyp)]
    return run(ref, hyp, *norms, *[F.when(wide(c), X.graphemes(X.normalise(c))) for c in (ref, hyp)])


def match_quality(rows: DataFrame) -> DataFrame:
    """rows: engine, truth, found (line ids or null) -> right, wrong, none, false, and precision and recall in ppm."""
    right = F.count_if(F.col("truth").isNotNull() & (F.col("found") == F.col("truth")))
    wrong = F.count_if(F.col("truth").isNotNull() & F.col("found").isNotNull() & (F.col("found") != F.col("truth")))
    none = F.count_if(F.col("truth").isNotNull() & F.col("found").isNull())
    false = F.count_if(F.col("truth").isNull() & F.col("found").isNotNull())
    got = rows.groupBy("engine").agg(right.alias("right"), wrong.alias("wrong"), none.alias("none"), false.alias("false"))
    ppm = lambda a, b: F.floor(a * 1_000_000 / F.greatest(b, F.lit(1))).cast("long")
    return got.withColumn("precision_ppm", ppm(F.col("right"), F.col("right") + F.col("wrong") + F.col("false"))).withColumn("recall_ppm", ppm(F.col("right"), F.col("right") + F.col("wrong") + F.col("none")))


def routing_cells(rows: DataFrame) -> DataFrame:
    """rows: why (or null), bad -> counts of the four cells."""
    routed = F.col("why").isNotNull()
    return rows.agg(F.count_if(routed & F.col("bad")).alias("caught"), F.count_if(routed & ~F.col("bad")).alias("needless"), F.count_if(~routed & F.col("bad")).alias("missed"), F.count_if(~routed & ~F.col("bad")).alias("fine"))


def bake_off(rows: DataFrame, bar: float = 0.90) -> DataFrame:
    """rows: lang, engine, book, accuracy -> engines that clear the bar on every book."""
    return rows.groupBy("lang", "engine").agg(F.bool_and(F.col("accuracy") >= bar).alias("chosen"), F.count("*").alias("books"))


def ingest_measure(rows: DataFrame) -> DataFrame:
    """Counts of the gate for paragraphs (style, text, line_ids, routed)."""
    body, quote = F.col("style") == "body", F.col("style") == "quote"
    ends = F.col("text").rlike("[.!?:;\"”’)।॥–—]\\s*$")
    ang = F.regexp_extract("text", r"([0-9]{2,4})\s*[^0-9]{0,24}$", 1).try_cast("int")
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return rows.agg(
        F.count("*").alias("paragraphs"), F.count_if(body).alias("body"), F.count_if(quote).alias("quotes"), F.count_if(F.col("style") == "heading").alias("headings"),
        F.sum(words).alias("words"), F.sum(F.regexp_count("text", F.lit("[a-z][A-Z]"))).alias("glue_defects"),
        F.count_if(body & (F.length("text") > 40) & ~ends).alias("body_mid_sentence"), F.count_if(quote & ang.between(62, 1430)).alias("quotes_with_ang"))


def _ngrams(items: list, n: int) -> Counter:
    return Counter(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


def chrf(hyps: list[str], refs: list[str], order: int = 6, beta: float = 2.0) -> float:
    """Corpus chrF (character n-grams without white space, F with beta 2), 0 to 100."""
    match, hyp, ref = [0] * order, [0] * order, [0] * order
    for h, r in zip(hyps, refs, strict=True):
        h, r = "".join(h.split()), "".join(r.split())
        for n in range(order):
            a, b = _ngrams(h, n + 1), _ngrams(r, n + 1)
            match[n] += sum((a & b).values())
            hyp[n] += sum(a.values())
            ref[n] += sum(b.values())
    used = [n for n in range(order) if hyp[n] and ref[n]]
    if not used:
        return 0.0
    p, r = (sum(match[n] / x[n] for n in used) / len(used) for x in (hyp, ref))
    return 100 * (1 + beta**2) * p * r / (beta**2 * p + r) if p + r else 0.0


def bleu(hyps: list[str], refs: list[str], order: int = 4) -> float:
    """Corpus BLEU on white-space and punctuation tokens, exponential smoothing of empty orders, 0 to 100."""
    import re

    cut = lambda s: re.findall(r"\w+|[^\w\s]", s)
    match, total, hl, rl = [0] * order, [0] * order, 0, 0
    for h, r in zip(map(cut, hyps), map(cut, refs), strict=True):
        hl, rl = hl + len(h), rl + len(r)
        for n in range(order):
            a = _ngrams(h, n + 1)
            match[n] += sum((a & _ngrams(r, n + 1)).values())
            total[n] += sum(a.values())
    if not hl or not match[0]:
        return 0.0
    smooth, logs = 1.0, []
    for m, t in zip(match, total, strict=True):
        if not t:
            continue
        if not m:
            smooth *= 2
        logs.append(math.log(m / t if m else 1 / (smooth * t)))
    brevity = 1.0 if hl >= rl else math.exp(1 - rl / hl)
    return 100 * brevity * math.exp(sum(logs) / len(logs))


def translation_scores(rows: DataFrame) -> DataFrame:
    """rows: engine, src, hyp, ref -> engine, chrf, bleu, ratio, scored.  Engines are few, their bench samples small (tens of pairs)."""
    import pandas as pd

    def run(f: pd.DataFrame) -> pd.DataFrame:
        pairs = f[(f["hyp"].fillna("") != "") & (f["ref"].fillna("") != "")]
        h, r = pairs["hyp"].tolist(), pairs["ref"].tolist()
        full = f[f["hyp"].fillna("") != ""]
        ratio = full["hyp"].str.len().sum() / max(1, full["src"].str.len().sum())
        return pd.DataFrame([(f["engine"].iloc[0], round(chrf(h, r), 1) if h else 0.0, round(bleu(h, r), 1) if h else 0.0, round(float(ratio), 2), len(h))], columns=["engine", "chrf", "bleu", "ratio", "scored"])

    return rows.groupBy("engine").applyInPandas(run, "engine string, chrf double, bleu double, ratio double, scored long")


def bench_lines(rows: DataFrame, styles: list[str], lang: str, least: int = 40) -> DataFrame:
    """Rows (style, lang, text, ...) that a translation bench may draw: prose of these styles, not in English, long enough, without
    a verse's danda; white space in ``text`` is folded.  A row without ``lang`` has the work's."""
    text, of = F.col("text"), F.coalesce("lang", F.lit(lang))
    fit = F.col("style").isin(styles) & (of != "en") & (F.length(text) >= least) & ~text.contains("॥")
    return rows.where(fit).withColumn("text", F.trim(F.regexp_replace(text, r"\s+", " ")))


def render_report(pages: DataFrame) -> DataFrame:
    """pages: book, angle (null: 0), skipped -> rendered, there, and the mean and largest absolute angle of the rendered ones."""
    done = ~F.coalesce("skipped", F.lit(False))
    angle = F.when(done, F.abs(F.coalesce("angle", F.lit(0.0))))
    sums = [F.count_if(done).alias("rendered"), F.count_if(~done).alias("there")]
    return pages.groupBy("book").agg(*sums, F.coalesce(F.avg(angle), F.lit(0.0)).alias("mean_angle"), F.coalesce(F.max(angle), F.lit(0.0)).alias("max_angle"))
