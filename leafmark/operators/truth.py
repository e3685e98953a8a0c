"""Verified lines against what an engine read: the reading inside each truth box, cut to the part that answers it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .alignment import best_window

V_SHARE, H_SHARE, WORD_SHARE = 0.5, 0.3, 0.5


def _covered(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """The part of a .. b that the second range covers."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0)) / F.greatest(F.lit(1), a1 - a0)


def readings(truth: DataFrame, lines: DataFrame, page: list[str]) -> DataFrame:
    """truth (page, id, x0 y0 x1 y1, text, kind) with ``hyp``: what the engine's lines over each box read, left to right.

    ``lines``: page, n, x0 y0 x1 y1, text, merged_into, words array<struct<x0,y0,x1,y1,text>>.  A line must cover half of a box's
    height and 0.3 of its width.  A continuation that was merged into another line is read after that one's text; a line with
    words on both sides of the box's edge gives the words inside.  Truth on pages the engine never read is left out.
    """
    anchors = lines.select(*page, F.col("n").alias("merged_into"), F.col("text").alias("anchor"))
    whole = lines.join(anchors, [*page, "merged_into"], "left").withColumn("read", F.when(F.col("anchor").isNotNull(), F.concat_ws(" ", "anchor", F.coalesce("text", F.lit("")))).otherwise(F.col("text")))
    t = truth.select(*page, "id", *[F.col(k).alias(f"t_{k}") for k in ("x0", "y0", "x1", "y1")])
    hits = whole.join(t, page).where((_covered(F.col("t_y0"), F.col("t_y1"), F.col("y0"), F.col("y1")) >= V_SHARE) & (_covered(F.col("t_x0"), F.col("t_x1"), F.col("x0"), F.col("x1")) >= H_SHARE))
    inside = F.filter(F.coalesce("words", F.array().cast(lines.schema["words"].dataType)), lambda w: _covered(w["x0"], w["x1"], F.col("t_x0"), F.col("t_x1")) >= WORD_SHARE)
    part = F.when((F.size(inside) > 0) & (F.size(inside) < F.size("words")), F.array_join(F.transform(inside, lambda w: w["text"]), " ")).otherwise(F.col("read"))
    got = hits.select(*page, "id", "x0", "n", part.alias("part")).groupBy(*page, "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "n", "part"))), lambda x: x["part"]), " ").alias("whole"))
    seen = truth.join(lines.select(*page).distinct(), page, "left_semi").join(got, [*page, "id"], "left").withColumn("whole", F.coalesce("whole", F.lit("")))
    return seen.withColumn("hyp", window_of(F.col("text"), F.col("whole"))).drop("whole")


def window_of(ref: Column, hyp: Column) -> Column:
    """The part of a longer reading that answers one truth line: the best window of the truth's length, in clusters.

    A reading of up to 1.2 times the truth and four more, or of a truth under four clusters, is taken whole.
    """
    r, h = X.graphemes(X.normalise(ref)), X.graphemes(X.normalise(hyp))

    @F.pandas_udf("string")
    def cut(rs: pd.Series, hs: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(rs, hs, strict=True):
            lo, hi = best_window(list(b), list(a))
            out.append("".join(b[lo:hi]))
        return pd.Series(out)

    long = (F.size(h) > 1.2 * F.size(r) + 4) & (F.size(r) >= 4)
    return F.when(long, cut(F.when(long, r).otherwise(F.array().cast("array<string>")), F.when(long, h).otherwise(F.array().cast("array<string>")))).otherwise(hyp)
