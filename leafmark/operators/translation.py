"""Requests to translation engines: pieces, batches, checks, retries, and the engine interface."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CLAUSE = r"(?<=[।॥])"


def pieces(c: Column, limit: int) -> Column:
    """A text cut behind dandas into pieces of at most ``limit`` characters; a longer clause stays whole."""
    clauses = F.filter(F.split(F.trim(c), _CLAUSE), lambda x: x != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(s: Column, x: Column) -> Column:
        full = (s["open"] != "") & (F.length(s["open"]) + F.length(x) > limit)
        return F.struct(F.when(full, F.concat(s["done"], F.array(F.trim(s["open"])))).otherwise(s["done"]).alias("done"), F.when(full, x).otherwise(F.concat(s["open"], x)).alias("open"))

    cut = F.aggregate(clauses, start, add, lambda s: F.when(F.trim(s["open"]) != "", F.concat(s["done"], F.array(F.trim(s["open"])))).otherwise(s["done"]))
    return F.when(F.length(F.trim(c)) <= limit, F.array(F.trim(c))).otherwise(cut)


def batches(records: list, size: int, limit: int = 8000, weigh: Callable = lambda r: len(json.dumps(r, ensure_ascii=False))) -> list[list]:
    """Batches that end at ``size`` records or before ``limit`` characters; one over the limit goes alone."""
    out, room = [], 0
    for r in records:
        w = weigh(r)
        if not out or len(out[-1]) >= size or limit and w > room:
            out.append([])
            room = limit
        out[-1].append(r)
        room -= w
    return out


def answer_fault(sent: Column, answer: Column) -> Column:
    """Why an answer is of no use, or null.

    sent: struct(id, src, pairs array<struct<w,src>>); answer: struct(id, en, pairs array<struct<w,en>>); null: not an object.
    """
    gurmukhi, en = "[਀-੿]", F.trim(F.regexp_replace(F.coalesce(answer["en"], F.lit("")), r"\s+", " "))
    words = lambda s: F.transform(s["pairs"], lambda p: F.coalesce(p["w"], F.lit("")))
    gloss = lambda p: F.trim(F.coalesce(p["en"], F.lit("")))
    paired = (
        F.when(answer["pairs"].isNull() | (F.size(answer["pairs"]) == 0), "no pairs")
        .when(words(sent) != words(answer), "headwords changed")
        .when(F.exists(answer["pairs"], lambda p: gloss(p) == ""), "empty gloss")
        .when(F.exists(answer["pairs"], lambda p: gloss(p).rlike(gurmukhi)), "gloss is not English")
    )
    plain = F.when(en == "", "empty").when(en.rlike(gurmukhi), "source script").when(~en.rlike("[A-Za-z]"), "no latin")
    return F.when(answer.isNull(), "not an object").when(F.coalesce(answer["id"], F.lit("")) != F.coalesce(sent["id"], F.lit("")), "another id").when(sent["pairs"].isNotNull(), paired).otherwise(plain)


def parsed_array(c: Column, element: str) -> Column:
    """The JSON array inside an engine's answer, from the first [ to the last ]; null where there is none."""
    return F.from_json(F.regexp_extract(c, r"(?s)(\[.*\])", 1), f"array<{element}>")


class Engine(Protocol):
    """What a translation or recognition engine offers; it is made once in each worker."""

    name: str

    def run(self, texts: list[str], lang: str) -> list[str]: ...

    def cost_usd(self, texts: list[str]) -> float: ...


class EchoEngine:
    """A stand-in without a model: marks its input.  Tests and dry runs use it; no query reports its output as a translation."""

    name = "echo"

    def run(self, texts: list[str], lang: str) -> list[str]:
        return [f"[{lang}] {t}" for t in texts]

    def cost_usd(self, texts: list[str]) -> float:
        return 0.0


_ENGINES: dict[str, Callable[[], Engine]] = {"echo": EchoEngine}


def register(name: str, make: Callable[[], Engine]) -> None:
    _ENGINES[name] = make


def engine(name: str) -> Engine:
    if name not in _ENGINES:
        raise ValueError(f"unknown engine {name}; known: {', '.join(sorted(_ENGINES))}")
    return _ENGINES[name]()


def first_available(names: list[str], profiles: dict[str, dict], installed: Callable[[dict], bool]) -> str | None:
    """The first of these model profiles that is known and whose weights are here, or None."""
    return next((n for n in names if n in profiles and installed(profiles[n])), None)


def retried(call: Callable, times: int = 5, wait: float = 1.0, passing: Callable[[Exception], bool] = lambda e: re.search(r"\b(429|5\d\d)\b", str(e)) is not None, sleep: Callable = time.sleep):
    """``call()`` again after passing errors, waiting twice as long each time."""
    for attempt in range(times):
        try:
            return call()
        except Exception as e:
            if attempt == times - 1 or not passing(e):
                raise
            sleep(wait * 2**attempt)


def translated(todo: DataFrame, make: Callable[[], Engine], lang: str, size: int = 8, limit: int = 8000) -> DataFrame:
    """unit_id, src -> unit_id, src, en, engine.  Rows are sorted by length in each partition, so batches hold texts of one size."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = make()
        for f in frames:
            out: list[str] = []
            for batch in batches(f["src"].tolist(), size, limit, len):
                out += retried(lambda b=batch: own.run(b, lang))
            yield f.assign(en=out, engine=own.name)

    rows = todo.select("unit_id", "src").withColumn("len", F.length("src")).sortWithinPartitions("len").drop("len")
    return rows.mapInPandas(run, "unit_id string, src string, en string, engine string")


def gated(todo: DataFrame, budget, price_per_char: float) -> DataFrame:
    """``todo`` if its estimated price fits what is left of the month, else an error: the gate before a paid call."""
    chars = todo.agg(F.sum(F.length("src"))).first()[0] or 0
    if not budget.allows(chars * price_per_char):
        raise RuntimeError(f"over budget: {chars * price_per_char:.4f} USD asked, {budget.cap - budget.spent_this_month():.4f} left")
    return todo
