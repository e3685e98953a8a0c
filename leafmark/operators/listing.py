"""Upserts and resuming: what a table becomes when new rows replace old ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_group(old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """Groups that ``new`` has come from it alone; the others keep their rows."""
    return old.join(new.select(group).distinct(), group, "left_anti").select(new.columns).unionByName(new)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows win by key; old ones without a successor stay."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(new.columns).unionByName(new)


def remaining(todo: DataFrame, done: DataFrame, key: str, done_key: str) -> DataFrame:
    """Rows whose key is not done; a chunk suffix '#c<n>' of a done id is ignored."""
    finished = done.select(F.regexp_replace(F.col(done_key), "#c[0-9]+$", "").alias(key)).distinct()
    return todo.join(finished, key, "left_anti")


def selected_pages(pages: DataFrame, wanted: DataFrame | None = None, only: list[DataFrame] | None = None, done: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """Pages (book, page) an engine has to read: those ``wanted``, in every table of ``only`` (pages with verified lines, routed
    pages), not ``done``; the first ``most`` of each book where a run is limited."""
    from pyspark.sql.window import Window

    for keep in [wanted, *(only or [])]:
        if keep is not None:
            pages = pages.join(keep.select("book", "page").distinct(), ["book", "page"], "left_semi")
    if done is not None:
        pages = pages.join(done.select("book", "page").distinct(), ["book", "page"], "left_anti")
    if most is None:
        return pages
    return pages.withColumn("r", F.row_number().over(Window.partitionBy("book").orderBy("page"))).where(F.col("r") <= most).drop("r")


def engines_with_output(outputs: DataFrame) -> DataFrame:
    """outputs: book, engine -> engines of each book in order of name; the merged reading, which is no engine, comes last."""
    own = F.array_sort(F.collect_set(F.when(F.col("engine") != "merged", F.col("engine"))))
    merged = F.coalesce(F.bool_or(F.col("engine") == "merged"), F.lit(False))
    tail = F.when(merged, F.array(F.lit("merged"))).otherwise(F.array().cast("array<string>"))
    return outputs.groupBy("book").agg(F.concat(own, tail).alias("engines"))


def missing_runs(truth: DataFrame, outputs: DataFrame, engines: dict[str, bool], paid_too: bool = False) -> DataFrame:
    """Pages (book, page) with verified lines that an engine has not read, with ``run``: false for paid engines unless ``paid_too``.

    ``engines``: whether each one is paid; a fixed list, so each page becomes that many rows and no join is needed for it.
    """
    every = F.array(*[F.struct(F.lit(name).alias("engine"), F.lit(paid_too or not paid).alias("run")) for name, paid in sorted(engines.items())])
    asked = truth.select("book", "page").distinct().select("book", "page", F.inline(every))
    return asked.join(outputs.select("book", "page", "engine").distinct(), ["book", "page", "engine"], "left_anti")
