"""Text runs of born-digital pages to lines and paragraphs, and the furniture around them.

Lines and paragraphs compare with an anchor (a line's first run, a paragraph's first line), not with the row before, so they
are made of whole pages, many at a time.
"""

from __future__ import annotations

import statistics
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .packing import by_page, ordered

# Units are points.
SAME_LINE, CHAR_WIDTH, SPACE, EXACT_SPACE, INDENT, GAP, BIG = 2.5, 0.46, 0.25, 0.12, 6.0, 1.6, 1.15
EDGE_LINES, HEAD_CHARS, HEAD_SHARE, STAMP_CHARS, STAMP_SHARE, HEAD_REPEATS = 2, 80, 0.30, 40, 0.60, 3


class Run(NamedTuple):
    x: float
    size: float
    text: str
    width: float
    space: float


def needs_space(prev_x: Column, prev_len: Column, prev_size: Column, prev_width: Column, prev_space: Column, x: Column) -> Column:
    """Whether a gap between two runs is a space: exact where the font states widths, else estimated."""
    exact = x - (prev_x + prev_width) > F.when(F.coalesce(prev_space, F.lit(0.0)) > 0, prev_space * 0.5).otherwise(EXACT_SPACE * prev_size)
    guess = x - (prev_x + prev_len * prev_size * CHAR_WIDTH) > SPACE * prev_size
    return F.when(prev_width.isNotNull(), exact).otherwise(guess)


def joined(runs: list) -> str:
    out = ""
    for prev, r in zip([None, *runs], runs, strict=False):
        if prev is not None and not r.text.startswith(" ") and not out.endswith(" "):
            known = prev.width is not None and prev.width == prev.width
            end = prev.x + (prev.width if known else len(prev.text) * prev.size * CHAR_WIDTH)
            least = (prev.space * 0.5 if prev.space and prev.space == prev.space else EXACT_SPACE * prev.size) if known else SPACE * prev.size
            out += " " * (r.x - end > least)
        out += r.text
    return " ".join(out.split())


def lines_of(runs: DataFrame, page: list[str]) -> DataFrame:
    """runs: page key, x, y (up), size, italic, text, width, space -> one row a line: n, y, x0, size, italic, text.

    Runs are rows, or arrays of structs in a column ``runs``.
    """
    fields = ["x", "y", "size", "italic", "text", "width", "space"]

    def work(t: pa.Table, bounds: np.ndarray) -> tuple[np.ndarray, list]:
        number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        x, y = (t.column(c).to_numpy() for c in ("x", "y"))
        order = np.lexsort((x, -y, number))
        page_of, ys, firsts = number[order].tolist(), y[order].tolist(), []
        at, anchor = -1, 0.0
        for i, v in enumerate(ys):  # a line's runs are near its first one, not near each other
            if page_of[i] != at or not abs(anchor - v) <= SAME_LINE:
                at, anchor = page_of[i], v
                firsts.append(i)
        starts = np.array(firsts)
        line = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ys))))
        top, own = np.array(ys)[starts], number[order][starts]
        order = order[np.lexsort((x[order], line))]
        t = t.take(pa.array(order))
        texts = t.column("text").combine_chunks()
        x, size, width, space = (t.column(c).to_numpy() for c in ("x", "size", "width", "space"))
        chars = pc.utf8_length(texts).to_numpy().astype(np.int64)
        slanted = pc.fill_null(t.column("italic"), False).to_numpy()
        ink = np.add.reduceat(chars, starts)
        tilted = np.add.reduceat(np.where(slanted, chars, 0), starts) > ink / 2
        ends = np.append(starts[1:], len(line))
        sizes = size[np.lexsort((size, line))]
        middle = (sizes[starts + (ends - starts - 1) // 2] + sizes[starts + (ends - starts) // 2]) / 2
        known = ~np.isnan(width)
        end = x + np.where(known, width, chars * size * CHAR_WIDTH)
        least = np.where(known, np.where(np.isnan(space) | (space == 0), EXACT_SPACE * size, space * 0.5), SPACE * size)
        gap = np.zeros(len(line), bool)
        gap[1:] = (x[1:] - end[:-1] > least[:-1]) & (line[1:] == line[:-1])
        gap[1:] &= ~pc.starts_with(texts, " ").to_numpy(zero_copy_only=False)[1:] & ~pc.ends_with(texts, " ").to_numpy(zero_copy_only=False)[:-1]
        pieces = pc.binary_join_element_wise(pa.array(np.where(gap, " ", "")), texts, "")
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(line)), pa.int32()), pieces), "").to_pylist()
        for k in np.unique(line[chars == 0]).tolist():  # what an empty run leaves at the end of the text before it is told run by run
            rows = range(starts[k], ends[k])
            whole[k] = joined([Run(float(x[i]), float(size[i]), texts[i].as_py(), float(width[i]), float(space[i])) for i in rows])
        n = np.arange(len(own)) - np.searchsorted(own, own) + 1
        return own, [n.astype(np.int64), top, x[starts], middle, tilted, [" ".join(w.split()) for w in whole]]

    return by_page(_fields(runs, page, "runs", fields), page, work, "n long, y double, x0 double, size double, italic boolean, text string")


def _fields(rows: DataFrame, page: list[str], nested: str, fields: list[str]) -> DataFrame:
    """Page keys and these fields; numbers are doubles."""
    cast = lambda get: [(F.col(c) if c in ("text", "italic") else get(c).cast("double")).alias(c) for c in fields]
    if nested not in rows.columns:
        return rows.select(*page, *cast(F.col))
    return rows.select(*page, F.col(nested).cast("array<struct<" + ",".join(f"{c}:{'string' if c == 'text' else 'boolean' if c == 'italic' else 'double'}" for c in fields) + ">>").alias(nested))


def left_margin(lines: DataFrame, page: list[str]) -> DataFrame:
    """margin: the x, to 2 units, that most lines of over 20 characters start at; the smallest where none recurs."""
    starts = lines.where(F.length("text") > 20).select(*page, "n", (F.bround(F.col("x0") / 2) * 2).alias("s"))
    counts = starts.groupBy(*page, "s").agg(F.count("*").alias("c"), F.min("n").alias("first"))
    best = counts.groupBy(*page).agg(F.max_by(F.struct("s", "c"), F.struct("c", -F.col("first"))).alias("b"), F.min("s").alias("low"))
    return best.select(*page, F.when(F.col("b.c") > 1, F.col("b.s")).otherwise(F.col("low")).alias("margin"))


def with_margin(lines: DataFrame, page: list[str]) -> DataFrame:
    """``lines`` with their page's left margin, null where no line is long enough; the lines are made once."""
    same, whole = Window.partitionBy(*page, "__s"), Window.partitionBy(*page)
    rows = lines.withColumn("__s", F.when(F.length("text") > 20, F.bround(F.col("x0") / 2) * 2))
    rows = rows.withColumn("__b", F.when(F.col("__s").isNotNull(), F.struct(F.count("*").over(same).alias("c"), (-F.min("n").over(same)).alias("first"), F.col("__s").alias("s"))))
    best = F.max("__b").over(whole)
    return rows.withColumn("margin", F.when(best["c"] > 1, best["s"]).otherwise(F.min("__s").over(whole))).drop("__s", "__b")


def is_spread(lines: DataFrame, page: list[str]) -> DataFrame:
    """Whether 80 % of the long lines start at 380 or beyond: the second page of a spread."""
    return lines.where(F.length("text") > 20).groupBy(*page).agg((F.avg((F.col("x0") >= 380).cast("int")) >= 0.8).alias("spread"))


def paragraphs_of(lines: DataFrame, page: list[str], body_size: float, italic_quotes: bool = True) -> DataFrame:
    """lines with ``margin`` -> paragraphs: para, style, italic, size, text.

    A paragraph ends on another style, a size more than 1 apart from its first line's, a gap over 1.6 usual ones, or an indent.
    With ``italic_quotes`` slanted lines are quotations; else a slanted line that opens a paragraph, shaped like a title, is a heading.
    """

    def paragraphs(own: list[tuple]) -> list[list]:
        gaps = [a[0] - b[0] for a, b in zip(own, own[1:], strict=False)]
        usual = statistics.median(gaps) if gaps else 0.0
        out: list[list] = []
        for i, (_, x0, size, italic, text, margin) in enumerate(own):
            wide = bool(usual) and i > 0 and gaps[i - 1] > usual * GAP
            big = size >= body_size * BIG and len(text) < 80
            inside = x0 > margin + INDENT
            if italic_quotes and italic:
                style = "quote"
            else:
                title = not italic_quotes and italic and (not out or wide or inside) and len(text) < 80 and text[-1] not in ".,;:"
                style = "heading" if big or title else "body"
            if not out or style != out[-1][0] or abs(size - out[-1][2]) > 1 or wide or style == "body" and inside:
                out.append([style, italic, size, [text]])
            else:
                out[-1][3].append(text if out[-1][3][-1].endswith("-") else " " + text)
        return out

    def work(t: pa.Table, bounds: np.ndarray) -> tuple[np.ndarray, list]:
        number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = ordered([number, t.column("n").to_numpy()])
        t = t if order is None else t.take(pa.array(order))
        fields = [t.column(c).to_numpy().tolist() for c in ("y", "x0", "size")] + [t.column(c).to_pylist() for c in ("italic", "text")] + [t.column("margin").to_numpy().tolist()]
        rows = list(zip(*fields, strict=True))
        pages, out = [], []
        for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            found = paragraphs([r for r in rows[lo:hi] if r[4]])
            pages += [k] * len(found)
            out += [(i, style, bool(italic), size, " ".join("".join(text).split())) for i, (style, italic, size, text) in enumerate(found, 1)]
        kinds = (pa.int64(), pa.string(), pa.bool_(), pa.float64(), pa.string())
        return np.array(pages, np.int64), [pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)]

    rows = lines.select(*page, F.col("n").cast("long").alias("n"), *[F.col(c).cast("double").alias(c) for c in ("y", "x0", "size")], "italic", "text", F.col("margin").cast("double").alias("margin"))
    return by_page(rows, page, work, "para long, style string, italic boolean, size double, text string")


def furniture(lines: DataFrame) -> dict[str, DataFrame]:
    """lines (book, page, n, text) -> heads, offset, stamps and repeated edge lines of each book.

    heads: short lines at a page's edge, number stripped, on 30 % of the pages; offset: page minus printed number, where one
    holds on as many; stamps: short lines on 60 % of the pages; repeated: edge lines on three pages or more.
    """
    rows = lines.withColumn("text", F.trim("text")).where("text <> ''")
    pages = rows.groupBy("book").agg(F.countDistinct("page").alias("pages"))
    ends = rows.groupBy("book", "page").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    edge = rows.join(ends, ["book", "page"]).where((F.col("n") < F.col("lo") + EDGE_LINES) | (F.col("n") > F.col("hi") - EDGE_LINES)).where(F.length("text") <= HEAD_CHARS)
    bare = edge.select("book", "page", F.trim(F.regexp_replace("text", r"^[0-9]{1,4}\s+|\s+[0-9]{1,4}$|^[0-9]{1,4}$", "")).alias("head")).where("head <> ''")
    seen = bare.groupBy("book", "head").agg(F.countDistinct("page").alias("on")).join(pages, "book")
    floor = F.greatest(F.lit(2), F.floor(F.col("pages") * HEAD_SHARE))
    numbers = edge.select("book", "page", F.explode(F.regexp_extract_all("text", F.lit("[0-9]{1,4}"), F.lit(0))).alias("k")).select("book", (F.col("page") - F.col("k").cast("int")).alias("offset"))
    offset = numbers.groupBy("book", "offset").agg(F.count("*").alias("on")).groupBy("book").agg(F.max_by(F.struct("offset", "on"), F.struct("on", -F.abs("offset"))).alias("b")).join(pages, "book").where(F.col("b.on") >= floor)
    short = rows.where(F.length("text") <= STAMP_CHARS).groupBy("book", "text").agg(F.countDistinct("page").alias("on")).join(pages, "book")
    return {
        "heads": seen.where(F.col("on") >= floor).select("book", "head", "on"),
        "offset": offset.select("book", "b.offset"),
        "stamps": short.where(F.col("on") >= F.greatest(F.lit(2), F.floor(F.col("pages") * STAMP_SHARE))).select("book", "text", "on"),
        "repeated": seen.where(F.col("on") >= HEAD_REPEATS).select("book", "head", "on"),
    }
