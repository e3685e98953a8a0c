"""Retrieval units: paragraphs merged into passages with the verses they lead into; and what feeds them."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: What a passage may end on.
ENDS = (".", "!", "?", ":", ";", "–", "—", "”", "’", '"', ")", "।", "॥")
_CUT = re.compile(r"(?<=[।॥.?!])\s+")
_SCHEMA = "work string, seq long, part string, page long, para_no long, text string, text_src string, cites array<string>, words long"


class _Builder:
    """The state of one work: the open unit, those closed, citations that wait for the next one."""

    def __init__(self, target: int, hard: int):
        self.target, self.hard = target, hard
        self.done: list[dict] = []
        self.open: dict | None = None
        self.waiting: list[str] = []

    def close(self) -> None:
        unit, self.open = self.open, None
        if unit is None:
            return
        if unit["body"] >= 3:
            self.done.append(unit)
        else:
            self.waiting += unit["cites"]

    @staticmethod
    def cite(unit: dict, cites: list[str]) -> None:
        unit["cites"] += [c for c in dict.fromkeys(cites) if c not in unit["cites"]]

    def quote(self, cites: list[str]) -> None:
        unit = self.open or (self.done[-1] if self.done else None)
        if unit is not None:
            self.cite(unit, cites)

    def prose(self, r, cites: list[str]) -> None:
        if self.open is not None and (r.style == "heading" and self.open["body"] > 0 or self.open["part"] != r.part):
            self.close()
        source = r.text_src
        for piece in [p for p in _CUT.split(" ".join(r.text.split())) if p]:
            if self.open is None:
                self.open = {"part": r.part, "page": r.page, "para_no": r.para_no, "text": [], "src": [], "words": 0, "body": 0, "cites": self.waiting}
                self.waiting = []
            self.cite(self.open, cites)
            cites = []
            if source:
                self.open["src"].append(source)
                source = None
            n = len(piece.split())
            self.open["text"].append(piece)
            self.open["words"] += n
            self.open["body"] += n * (r.style != "heading")
            if self.open["words"] >= self.hard or self.open["words"] >= self.target and piece.endswith(ENDS):
                self.close()

    def finish(self) -> list[dict]:
        self.close()
        if self.waiting and self.done:
            self.done[-1]["cites"] += self.waiting
        return self.done


def build_units(records: DataFrame, target: int = 60, hard: int = 220) -> DataFrame:
    """records: work, part, page, para_no, style, text, text_src, cites (group ids).  One task a work; input is read in order.

    A unit closes at ``target`` words on a sentence's end, at ``hard`` words, at a heading once it has prose, at a part's end.
    Units with under three words of prose are dropped; their citations go to the next unit.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        build = _Builder(target, hard)
        # parts in the order of their numbers (2 before 10; none first), named ones after them
        number = pd.to_numeric(rows["part"], errors="coerce")
        rank = number.where(rows["part"].notna(), float("-inf")).fillna(float("inf"))
        rows = rows.assign(_rank=rank).sort_values(["_rank", "part", "page", "para_no"], na_position="first", kind="stable").drop(columns="_rank")
        for r in rows.itertuples():
            cites = list(r.cites) if r.cites is not None else []
            build.quote(cites) if r.style == "quote" else build.prose(r, cites)
        work = rows["work"].iloc[0]
        out = [(work, i, u["part"], u["page"], u["para_no"], " ".join(u["text"]), " ".join(u["src"]) or None, u["cites"], u["words"]) for i, u in enumerate(build.finish())]
        return pd.DataFrame(out, columns=[x.split()[0] for x in _SCHEMA.replace("array<string>", "a").split(", ")])

    return records.groupBy("work").applyInPandas(run, _SCHEMA)


def numbered(units: DataFrame) -> DataFrame:
    """unit_row: dense from 0 over works by name, then seq.  Offsets come from counts by work, not from one window over all."""
    counts = units.groupBy("work").agg(F.count("*").alias("c"))
    offsets = counts.withColumn("offset", F.coalesce(F.sum("c").over(Window.orderBy("work").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    return units.join(offsets, "work").withColumn("unit_row", F.col("offset") + F.col("seq")).drop("offset")


def apply_translations(paragraphs: DataFrame, translations: DataFrame) -> DataFrame:
    """Quotes and English pass; others take their translation, the source in text_src; those without one go."""
    rows = paragraphs.join(translations.select("unit_id", "en"), "unit_id", "left")
    passes = (F.col("style") == "quote") | (F.col("lang") == "en")
    rows = rows.where(passes | F.col("en").isNotNull())
    return rows.select("unit_id", "style", F.when(passes, F.col("text")).otherwise(F.col("en")).alias("text"), F.when(~passes, F.col("text")).alias("text_src"), F.when(passes, F.col("lang")).otherwise(F.lit("en")).alias("lang"))


def kept_spans(paragraphs: DataFrame, spans: DataFrame) -> DataFrame:
    """spans: work, k, start, stop.  Records from the first that starts with ``start`` to the first later one that ends with
    ``stop``; a span without an end is an error."""
    order = Window.partitionBy("work").orderBy("page", "para_no")
    rows = paragraphs.withColumn("pos", F.row_number().over(order))
    s = rows.join(spans, "work").where(F.col("text").startswith(F.col("start"))).groupBy("work", "k", "stop").agg(F.min("pos").alias("lo"))
    e = rows.join(s, "work").where((F.col("pos") >= F.col("lo")) & F.col("text").endswith(F.col("stop"))).groupBy("work", "k", "lo").agg(F.min("pos").alias("hi"))
    fault = F.raise_error(F.concat(F.lit("span without an end: "), "start")).cast("int")
    e = spans.join(e, ["work", "k"], "left").select("work", F.when(F.col("hi").isNull(), fault).otherwise(F.col("lo")).alias("lo"), F.coalesce("hi", fault).alias("hi"))
    return rows.join(e, "work").where("pos BETWEEN lo AND hi").drop("pos", "lo", "hi")


def split_to_fit(text: str, limit: int, length=lambda s: len(s.split())) -> list[str]:
    """Sentences packed greedily into chunks of at most ``limit``; a longer sentence stands alone."""
    out: list[list[str]] = []
    size = 0
    for piece in [p for p in _CUT.split(text.strip()) if p]:
        n = length(piece)
        if not out or size + n > limit:
            out.append([])
            size = 0
        out[-1].append(piece)
        size += n
    return [" ".join(x) for x in out]


def group_documents(lines: DataFrame, limit: int) -> DataFrame:
    """lines: verse_group, line_id, kind, text -> verse_group, chunks: whole lines packed to ``limit`` words, the refrain first."""
    order = F.array_sort(F.collect_list(F.struct((F.col("kind") != "rahao").alias("later"), "line_id", "text", F.size(F.split(F.trim("text"), r"\s+")).alias("n"))))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))

    def add(s, x):
        full = (s["n"] > 0) & (s["n"] + x["n"] > limit)
        joined = F.when(s["open"] == "", x["text"]).otherwise(F.concat_ws(" ", s["open"], x["text"]))
        return F.struct(F.when(full, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]).alias("done"), F.when(full, x["text"]).otherwise(joined).alias("open"), F.when(full, x["n"]).otherwise(s["n"] + x["n"]).alias("n"))

    chunks = F.aggregate("ls", start, add, lambda s: F.when(s["n"] > 0, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]))
    return lines.groupBy("verse_group").agg(order.alias("ls")).select("verse_group", chunks.alias("chunks"))
