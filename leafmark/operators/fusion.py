"""Joining readings of one page by boxes, weighing engines, voting, routing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .packing import by_page

V_OVERLAP, H_OVERLAP, ORPHAN, BAR, DEFAULT_CONF = 0.5, 0.3, 0.4, 0.90, 0.8
AGREEMENT_LOW, CONF_LOW, OOV_WORDS, PAGE_LINES, PAGE_SHARE = 0.85, 0.5, 4, 3, 0.15
#: Unknown-word shares above which a line is shown to an arbiter, by language.
OOV_HIGH = {"pa": 0.25, "hi": 0.25, "en": 0.6}


def _share(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    inside = F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))
    return inside / F.greatest(F.lit(1), F.least(a1 - a0, b1 - b0))


def overlapping(pivot: DataFrame, other: DataFrame, page: list[str], v: float = V_OVERLAP, h: float | None = H_OVERLAP) -> DataFrame:
    """Pairs of a page's boxes that overlap by parts of the smaller: an equi-join on the page with the overlap as residue."""
    p = pivot.select(*page, *[F.col(k).alias(f"p_{k}") for k in ("n", "x0", "y0", "x1", "y1")])
    o = other.select(*page, *[F.col(k).alias(f"o_{k}") for k in ("n", "x0", "y0", "x1", "y1")], F.col("text").alias("o_text"))
    near = _share(F.col("p_y0"), F.col("p_y1"), F.col("o_y0"), F.col("o_y1")) >= v
    if h is not None:
        near = near & (_share(F.col("p_x0"), F.col("p_x1"), F.col("o_x0"), F.col("o_x1")) >= h)
    return p.join(o, page).where(near)


def aligned(pivot: DataFrame, other: DataFrame, page: list[str]) -> DataFrame:
    """page, n, text: the other engine's lines over each pivot line, left to right."""
    pairs = overlapping(pivot, other, page)
    parts = F.array_sort(F.collect_list(F.struct("o_x0", "o_n", "o_text")))
    return pairs.groupBy(*page, F.col("p_n").alias("n")).agg(F.trim(F.array_join(F.transform(parts, lambda x: x["o_text"]), " ")).alias("text"))


def orphans(pivot: DataFrame, other: DataFrame, page: list[str], tallest: float = 2.5) -> DataFrame:
    """Lines of the other engine that no pivot line covers, not taller than ``tallest`` typical lines; the first pass."""
    covered = overlapping(pivot, other, page, ORPHAN, None).select(*page, F.col("o_n").alias("n")).distinct()
    usual = pivot.groupBy(*page).agg(F.array_sort(F.collect_list(F.col("y1") - F.col("y0"))).alias("hs")).select(*page, F.element_at("hs", (F.size("hs") / 2).cast("int") + 1).alias("usual"))
    left = other.join(covered, [*page, "n"], "left_anti").join(usual, page)
    return left.where(F.col("y1") - F.col("y0") <= tallest * F.col("usual")).drop("usual")


def adopted(orphaned: DataFrame, page: list[str]) -> DataFrame:
    """The sequential part: in order of y0, an orphan that an adopted one covers is left out.  Whole pages, many at a time."""
    names = [c for c in orphaned.columns if c not in page]

    def work(t: pa.Table, bounds: np.ndarray) -> tuple[np.ndarray, list]:
        number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        y0, y1, x0, n = (t.column(c).to_numpy() for c in ("y0", "y1", "x0", "n"))
        order = np.lexsort((n, x0, y0, number))
        keep, at, taken = [], -1, []
        for i, k, low, high in zip(order.tolist(), number[order].tolist(), y0[order].tolist(), y1[order].tolist(), strict=True):
            taken = [(a, b) for a, b in taken if b > low] if k == at else []  # those that end above never cover a later one
            at = k
            if all(max(0, min(high, b) - max(low, a)) / max(1, min(high - low, b - a)) < ORPHAN for a, b in taken):
                taken.append((low, high))
                keep.append(i)
        kept = t.take(pa.array(keep, pa.int64()))
        return number[keep], [kept.column(c).combine_chunks() for c in names]

    kind = dict(orphaned.dtypes)
    return by_page(orphaned, page, work, ", ".join(f"{c} {kind[c]}" for c in names)).select(*orphaned.columns)


def auto_weights(accuracy: DataFrame) -> DataFrame:
    """engine, weight: accuracy ** 4 to three places; 0.5 where it was never measured."""
    return accuracy.select("engine", F.when(F.col("accuracy").isNull(), 0.5).otherwise(F.bround(F.pow("accuracy", F.lit(4)), 3)).alias("weight"))


def voters(engines: DataFrame, accuracy: DataFrame, pivot: str) -> DataFrame:
    """Engines that may vote: those measured under the bar go, never the pivot, never the unmeasured."""
    return engines.join(accuracy, "engine", "left").where((F.col("engine") == pivot) | F.col("accuracy").isNull() | (F.col("accuracy") >= BAR)).select("engine")


def positional_vote(lines: DataFrame) -> DataFrame:
    """``lines`` with ``readings`` array<struct<items, weight, conf>> of one length, the pivot first -> text, agreement, same, columns, voters.

    Each position goes to the item whose readings weigh most together; the pivot is heavier by a hair; agreement is the share
    of unanimous positions, null for a single witness.  Positions of many lines are voted on at once.
    """
    heavier = F.transform("readings", lambda r, k: F.struct(r["items"].alias("items"), (r["weight"] * F.coalesce(r["conf"], F.lit(DEFAULT_CONF)) + F.when(k == 0, 1e-6).otherwise(0.0)).cast("double").alias("w")))
    rows = lines.withColumn("won", _won(heavier))
    rows = rows.withColumn("text", F.col("won.text")).withColumn("same", F.col("won.same"))
    rows = rows.withColumn("columns", F.size(F.get("readings", F.lit(0))["items"]).cast("long")).withColumn("voters", F.size("readings"))
    return rows.withColumn("agreement", F.when(F.col("voters") > 1, F.bround(F.try_divide(F.col("same").cast("double"), F.col("columns")), 3))).drop("readings", "won")


def _won(readings: Column) -> Column:
    """struct(text, same): the best supported item of each place of the pivot, and how many places all readings agree on."""

    @F.arrow_udf("text string, same long")
    def run(col: pa.Array) -> pa.Array:
        given = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
        first = np.cumsum(given) - given  # of each line's readings
        items, weights = col.flatten().flatten()
        sizes = pc.fill_null(pc.list_value_length(items), 0).to_numpy(zero_copy_only=False)
        begin = np.append(np.cumsum(sizes) - sizes, 0)
        sizes, w = np.append(sizes, 0), np.append(weights.to_numpy(zero_copy_only=False), np.nan)
        coded = pc.dictionary_encode(items.flatten())
        codes = np.append(pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False), -1)
        n = sizes[np.where(given > 0, first, -1)]
        line = np.repeat(np.arange(len(given)), n)
        place = np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)
        most = int(given.max()) if len(given) else 0
        has, own, heavy = [], [], []
        for k in range(most):
            reading = np.where(k < given, first + k, -1)[line]
            has.append(reading >= 0)
            own.append(codes[np.where(place < sizes[reading], begin[reading] + place, -1)])
            heavy.append(w[reading])
        best, winner, same = np.full(len(line), -np.inf), np.full(len(line), -1, codes.dtype), np.ones(len(line), bool)
        for k in range(most):
            support = np.zeros(len(line))
            for j in range(most):
                support += np.where((own[j] == own[k]) & (own[k] >= 0) & has[j], heavy[j], 0.0)
            support = np.where(np.isnan(support), -np.inf, np.rint(support * 1e9))  # to nine places, as sums of parts differ by a hair
            better = has[k] & ((support > best) | (k == 0))
            best, winner = np.where(better, support, best), np.where(better, own[k], winner)
            same &= ~has[k] | ((own[k] == own[0]) & (own[k] >= 0))
        chosen = pc.fill_null(coded.dictionary.take(pa.array(winner, mask=winner < 0)), "")
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), chosen), "")
        return pa.StructArray.from_arrays([text, pa.array(np.bincount(line[same], minlength=len(given)).astype(np.int64))], ["text", "same"])

    return run(readings)


def stamped(readings: DataFrame, line: list[str]) -> DataFrame:
    """Lines that some engine read as a stamp: one that read it plainly settles it for those that did not."""
    from ..functions.text import is_stamp

    return readings.where(is_stamp(F.col("text"))).select(*line).distinct()


def kind_of(bold: Column, matched: Column, text: Column) -> Column:
    few = F.size(F.split(F.trim(text), " +")) <= 6
    verse = text.contains("॥")
    return F.when(matched, "gurbani").when(bold & few & text.rlike("^ਰਾਗ|^ਰਾਗੁ"), "heading").when(bold & verse, "gurbani-unmatched").when(bold & few, "heading").otherwise("commentary")


def arbiter_reason(kind: Column, agreement: Column, oov: Column, n_words: Column, conf: Column, lang: str = "en") -> Column:
    """Why a line should be read again by a paid engine, or null."""
    high = OOV_HIGH.get(lang, 0.25)
    return (
        F.when(kind == "gurbani", F.lit(None).cast("string"))
        .when(kind == "gurbani-unmatched", "unmatched-bold")
        .when(agreement.isNotNull() & (agreement < AGREEMENT_LOW), "low-agreement")
        .when((F.coalesce(oov, F.lit(0.0)) > high) & (F.coalesce(n_words, F.lit(OOV_WORDS)) >= OOV_WORDS), "oov")
        .when(conf.isNotNull() & (conf < CONF_LOW), "low-conf")
    )


def routed_pages(lines: DataFrame, page: list[str]) -> DataFrame:
    """Pages to route: three doubtful body lines, or 15 % of them; unmatched bold lines count in ``reasons`` only."""
    body = lines.where("zone = 'body'")
    why = body.where("why is not null").groupBy(*page, "why").agg(F.count("*").alias("c"))
    reasons = why.groupBy(*page).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("why", "c")))).alias("reasons"), F.sum(F.when(F.col("why") != "unmatched-bold", F.col("c")).otherwise(0)).alias("lines"))
    total = body.groupBy(*page).agg(F.count("*").alias("body"))
    return total.join(reasons, page).where((F.col("lines") >= PAGE_LINES) | (F.col("lines") / F.col("body") >= PAGE_SHARE)).select(*page, "body", "lines", "reasons")


def disputed_words(readings: DataFrame, key: list[str]) -> DataFrame:
    """Words of the merged text that some other reading lacks."""
    return readings.select(*key, F.array_except("words", F.aggregate("others", F.col("words"), lambda a, x: F.array_intersect(a, x))).alias("disputed"))


def first_seen_mode(rows: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The commonest value; ties go to the one seen first."""
    counts = rows.groupBy(*key, value).agg(F.count("*").alias("c"), F.min(order).alias("first"))
    return counts.groupBy(*key).agg(F.max_by(value, F.struct("c", -F.col("first"))).alias(value))


def upper_median(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """sorted[n // 2], by rank in the group."""
    w = Window.partitionBy(*key).orderBy(value)
    ranked = rows.select(*key, value, F.row_number().over(w).alias("r"), F.count("*").over(Window.partitionBy(*key)).alias("n"))
    return ranked.where(F.col("r") == F.floor(F.col("n") / 2) + 1).select(*key, F.col(value).alias("median"))


def low_tenth(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """sorted[n // 10]."""
    w = Window.partitionBy(*key).orderBy(value)
    ranked = rows.select(*key, value, F.row_number().over(w).alias("r"), F.count("*").over(Window.partitionBy(*key)).alias("n"))
    return ranked.where(F.col("r") == F.floor(F.col("n") / 10) + 1).select(*key, F.col(value).alias("p10"))
