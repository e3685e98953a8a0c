"""Recognition engines: the adapter interface, and the parsing of what they return."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.packing import by_page, extreme, keyed, ordered

LINE = "page long, n long, x0 int, y0 int, x1 int, y1 int, text string, conf double, zone string"


class Recogniser(Protocol):
    """Pages of image bytes to lines; made once in each worker, so a model loads once."""

    name: str

    def recognise(self, image: bytes, lang: str) -> list[dict]: ...

    def cost_usd(self, pages: int) -> float: ...


class BlankRecogniser:
    """A stand-in that reads nothing: libraries and weights of real engines are not part of this package."""

    name = "blank"

    def recognise(self, image: bytes, lang: str) -> list[dict]:
        return []

    def cost_usd(self, pages: int) -> float:
        return 0.0


_KNOWN: dict[str, Callable[[], Recogniser]] = {"blank": BlankRecogniser}


def register(name: str, make: Callable[[], Recogniser]) -> None:
    _KNOWN[name] = make


def load(name: str) -> Recogniser:
    if name not in _KNOWN:
        raise ValueError(f"unknown engine {name}; known: {', '.join(sorted(_KNOWN))}")
    return _KNOWN[name]()


def recognised(pages: DataFrame, make: Callable[[], Recogniser], lang: str) -> DataFrame:
    """pages: page, image -> lines."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = make()
        for f in frames:
            rows = [(p, n, *ln["bbox"], ln["text"], ln.get("conf"), ln.get("zone")) for p, image in zip(f["page"], f["image"], strict=True) for n, ln in enumerate(own.recognise(image, lang), 1)]
            yield pd.DataFrame(rows, columns=["page", "n", "x0", "y0", "x1", "y1", "text", "conf", "zone"])

    return pages.select("page", "image").mapInPandas(run, LINE)


def confidence(c: Column) -> Column:
    """Confidences over 1 are percentages."""
    return F.when(c > 1, c / 100.0).otherwise(c)


def lines_of_words(words: DataFrame, page: list[str]) -> DataFrame:
    """Word table (block, par, line, word, left, top, width, height, text, conf) to lines; empty words and conf -1 are passed over."""
    rows = words.where("trim(text) <> '' AND conf >= 0")
    rows = rows.select(*page, "block", "par", "line", "word", "left", "top", (F.col("left") + F.col("width")).alias("right"), (F.col("top") + F.col("height")).alias("bottom"), "text", F.col("conf").cast("double").alias("conf"))
    kind = dict(rows.dtypes)

    def work(t: pa.Table, bounds: np.ndarray) -> tuple[np.ndarray, list]:
        number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        places = [k for c in ("block", "par", "line") for k in keyed(t.column(c))]
        order = ordered([number, *places, *keyed(t.column("left")), *keyed(t.column("word")), *keyed(t.column("text"))])
        if order is not None:
            t, number, places = t.take(pa.array(order)), number[order], [k[order] for k in places]
        new = np.zeros(len(number), bool)
        new[:1] = True
        for k in (number, *places):
            new[1:] |= k[1:] != k[:-1]
        starts = np.flatnonzero(new)
        box = {n: extreme(t.column(c), starts, low) for n, c, low in (("x0", "left", True), ("y0", "top", True), ("x1", "right", False), ("y1", "bottom", False))}
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(number)), pa.int32()), t.column("text").combine_chunks()), " ")
        mean = np.add.reduceat(t.column("conf").to_numpy(), starts) / np.diff(np.append(starts, len(number)))
        lines = [t.column(c).combine_chunks().take(pa.array(starts)) for c in ("block", "par", "line")]
        # block, par and line come sorted; their order within the page settles ties
        again = ordered([number[starts], *keyed(box["y0"]), *keyed(box["x0"])])
        again = np.arange(len(starts)) if again is None else again
        own = number[starts][again]
        n = np.arange(len(own)) - np.searchsorted(own, own) + 1
        return own, [x.take(pa.array(again)) for x in (*lines, box["x0"], box["y0"], box["x1"], box["y1"], text, pa.array(mean))] + [n.astype(np.int64)]

    schema = f"block {kind['block']}, par {kind['par']}, line {kind['line']}, x0 {kind['left']}, y0 {kind['top']}, x1 {kind['right']}, y1 {kind['bottom']}, text string, conf double, n long"
    return by_page(rows, page, work, schema).withColumn("conf", F.bround(F.col("conf") / 100, 3))


def lines_of_symbols(symbols: DataFrame, page: list[str]) -> DataFrame:
    """Symbols (seq, text, brk, x0, y0, x1, y1) of a cloud engine to lines: a space after breaks 1 and 2, a new line after 3 and 5.

    Symbols are rows, or arrays of structs in a column ``symbols``, as an engine's answer has them; arrays cost far less.
    """
    fields = ["seq", "text", "brk", "x0", "y0", "x1", "y1"]
    rows = symbols.select(*page, *(["symbols"] if "symbols" in symbols.columns else fields))
    kind = dict(rows.selectExpr("inline(symbols)").dtypes if "symbols" in symbols.columns else rows.dtypes)

    def work(t: pa.Table, bounds: np.ndarray) -> tuple[np.ndarray, list]:
        number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = ordered([number, *keyed(t.column("seq"))])
        t = t if order is None else t.take(pa.array(order))
        brk = pc.fill_null(t.column("brk"), 0).to_numpy()
        over = np.cumsum(np.isin(brk, (3, 5)))
        line = np.concatenate([[0], over[:-1]])  # breaks before the row, then those of its own page
        line -= line[bounds[:-1]][number]
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (number[1:] != number[:-1])
        starts = np.flatnonzero(new)
        lists = lambda c: pa.ListArray.from_arrays(pa.array(np.append(starts, len(line)), pa.int32()), c)
        text = t.column("text").combine_chunks()
        piece = pc.fill_null(pc.binary_join_element_wise(text, pa.array(np.where(np.isin(brk, (1, 2)), " ", "")), ""), "")
        text = pc.utf8_trim(pc.binary_join(lists(piece), ""), " ")
        return number[starts], [line[starts].astype(np.int64), text, *(extreme(t.column(c), starts, low) for c, low in (("x0", True), ("y0", True), ("x1", False), ("y1", False)))]

    return by_page(rows, page, work, "line long, text string, " + ", ".join(f"{c} {kind[c]}" for c in ("x0", "y0", "x1", "y1")))


def unmarked(c: Column) -> Column:
    """Text without Markdown's headings, emphasis and rules."""
    out = F.regexp_replace(c, r"(?m)^#{1,6}\s+", "")
    return F.trim(F.regexp_replace(out, r"\*\*|__|(?m)^-{3,}$", ""))


def probed(pages: DataFrame) -> DataFrame:
    """Shape of a file from sampled pages (file, chars, legacy_font): text, legacy-font or image."""
    got = pages.groupBy("file").agg(F.avg("chars").alias("mean"), F.bool_or("legacy_font").alias("legacy"))
    return got.select("file", F.when(F.col("mean") < 120, "image").when(F.col("legacy"), "legacy-font").otherwise("text").alias("shape"))


def readable(sources: DataFrame, readers: dict[str, Callable[[str], DataFrame]], spark) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Rows of all files by their readers, and (file, error) of those that failed: one bad file does not stop the others."""
    out, failed = None, []
    for r in sources.select("file", "reader").collect():  # a manifest: some hundred files at most
        try:
            own = readers[r.reader](r.file).withColumn("file", F.lit(r.file))
            out = own if out is None else out.unionByName(own, allowMissingColumns=True)
        except Exception as e:
            failed.append((r.file, f"{type(e).__name__}: {e}"))
    return out, failed
