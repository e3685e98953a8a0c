"""Page layout: zones, columns, paragraphs, furniture.  Boxes are x0, y0, x1, y1 columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X

HEADER_BAND, FOOTER_BAND, HEADER_CHARS, SMALL = 0.075, 0.06, 90, 0.85


def split_block(blocks: DataFrame, key: list[str]) -> DataFrame:
    """Blocks of several lines as lines of equal height, numbered from 1; blank lines are left out."""
    lines = F.filter(F.split("text", "\n"), lambda s: F.trim(s) != "")
    rows = blocks.withColumn("ls", lines).select(*key, "x0", "x1", "y0", "y1", F.size("ls").alias("k"), F.posexplode("ls").alias("pos", "text"))
    top, height = F.col("y0"), F.col("y1") - F.col("y0")
    cut = lambda i: (top + F.floor(height * i / F.col("k"))).cast("int")
    return rows.select(*key, (F.col("pos") + 1).cast("long").alias("n"), "x0", cut(F.col("pos")).alias("y0"), "x1", cut(F.col("pos") + 1).alias("y1"), F.trim("text").alias("text"))


def numbered(lines: DataFrame, page: list[str]) -> DataFrame:
    return lines.withColumn("n", F.row_number().over(Window.partitionBy(*page).orderBy("y0", "x0", "text")))


def zones(lines: DataFrame, page: list[str]) -> DataFrame:
    """lines (page key, n, box, text, page_w, page_h, rule_y, stamps array of boxes, zone or null) with their zone.

    First match: a zone set before, empty, stamp, page number, header, below the rule, body.  Without a rule the last run of
    small body lines is a footnote from the first of them that starts with a number.
    """
    w = Window.partitionBy(*page)
    height = F.col("y1") - F.col("y0")
    real = F.trim(F.coalesce("text", F.lit(""))) != ""
    sizes = F.array_sort(F.collect_list(F.when(real, height)).over(w))
    rows = lines.withColumn("body_h", F.when(F.size(sizes) > 0, F.element_at(sizes, (F.size(sizes) / 2).cast("int") + 1)).otherwise(0))
    text, yc = F.trim(F.coalesce("text", F.lit(""))), (F.col("y0") + F.col("y1")) / 2.0
    area = F.greatest(F.lit(1), (F.col("x1") - F.col("x0")) * height)

    def covered(s):
        ix = F.greatest(F.lit(0), F.least(F.col("x1"), s["x1"]) - F.greatest(F.col("x0"), s["x0"]))
        iy = F.greatest(F.lit(0), F.least(F.col("y1"), s["y1"]) - F.greatest(F.col("y0"), s["y0"]))
        return ix * iy >= 0.5 * area

    stamped = X.is_stamp(text) | F.coalesce(F.exists("stamps", covered), F.lit(False))
    zone = (
        F.when(F.col("zone").isin("header", "stamp", "footnote", "pageno", "body"), F.col("zone"))
        .when(text == "", "body")
        .when(stamped, "stamp")
        .when(text.rlike(X.PAGE_NUMBER) & ((yc < F.col("page_h") * HEADER_BAND * 1.5) | (yc > F.col("page_h") * (1 - FOOTER_BAND * 1.5))), "pageno")
        .when((yc < F.col("page_h") * HEADER_BAND) & (F.length(text) <= HEADER_CHARS), "header")
        .when(F.coalesce(F.col("y0") > F.col("rule_y"), F.lit(False)), "footnote")
        .otherwise("body")
    )
    rows = rows.withColumn("zone", zone)
    up = Window.partitionBy(*page, "zone").orderBy(F.desc("y0"), F.desc("n"))
    small = height < F.col("body_h") * SMALL
    rows = rows.withColumn("tail", (F.col("zone") == "body") & F.col("rule_y").isNull() & (F.col("body_h") > 0) & (F.sum(F.when(small, 0).otherwise(1)).over(up) == 0))
    first = F.min(F.when(F.col("tail") & F.coalesce("text", F.lit("")).rlike(X.FOOTNOTE_START), F.struct("y0", "n"))).over(w)
    note = F.col("tail") & first.isNotNull() & (F.struct("y0", "n") >= first)
    return rows.withColumn("zone", F.when(note, "footnote").otherwise(F.col("zone"))).drop("tail", "body_h")


def quiet_bands(starts: DataFrame, page: list[str], width: int, bin_size: int = 8, tolerance: int = 400) -> DataFrame:
    """Gaps and islands of a start-position histogram: the widest band in the middle 15-85 % with few starts in each bin."""
    hist = starts.groupBy(*page, F.floor(F.col("x") / bin_size).cast("int").alias("bin")).agg(F.count("*").alias("c"))
    total = starts.groupBy(*page).agg(F.count("*").alias("total"))
    bins = total.select(*page, "total", F.explode(F.sequence(F.lit(int(width * 0.15) // bin_size), F.lit(int(width * 0.85) // bin_size))).alias("bin"))
    full = bins.join(hist, [*page, "bin"], "left").withColumn("quiet", F.coalesce("c", F.lit(0)) <= F.floor(F.col("total") / tolerance))
    order = Window.partitionBy(*page).orderBy("bin")
    isles = full.withColumn("isle", F.sum(F.when(F.col("quiet"), 0).otherwise(1)).over(order)).where("quiet")
    bands = isles.groupBy(*page, "isle").agg((F.min("bin") * bin_size).alias("lo"), ((F.max("bin") + 1) * bin_size).alias("hi"))
    best = bands.groupBy(*page).agg(F.max_by(F.struct("lo", "hi"), F.struct(F.col("hi") - F.col("lo"), -F.col("lo"))).alias("b"))
    return best.select(*page, F.col("b.lo").cast("long").alias("lo"), F.col("b.hi").cast("long").alias("hi"))


def gutters(starts: DataFrame, page: list[str], width: int, share: float = 0.25, least_width: float = 0.02, least_starts: int = 40) -> DataFrame:
    """Pages of two columns: a quiet band wide enough with ``share`` of the starts on either side."""
    band = quiet_bands(starts, page, width).where(F.col("hi") - F.col("lo") >= width * least_width)
    sides = starts.join(band, page).groupBy(*page, "lo", "hi").agg(F.count_if(F.col("x") < F.col("lo")).alias("left"), F.count_if(F.col("x") >= F.col("hi")).alias("right"), F.count("*").alias("n"))
    return sides.where((F.col("n") >= least_starts) & (F.least("left", "right") >= share * F.col("n"))).select(*page, "lo", "hi", "left", "right")


def paragraph_breaks(lines: DataFrame, page: list[str]) -> DataFrame:
    """lines (page key, n, y, x, size, italic, text; y grows downwards) with para: breaks on style, size, gap or indent."""
    order = Window.partitionBy(*page).orderBy("n")
    whole = Window.partitionBy(*page)
    rows = lines.withColumn("gap", F.col("y") - F.lag("y").over(order))
    rows = rows.withColumn("usual", F.percentile(F.when(F.col("gap") > 0, F.col("gap")), F.lit(0.5)).over(whole)).withColumn("margin", F.min("x").over(whole))
    cut = (
        F.lag("n").over(order).isNull()
        | (F.col("italic") != F.lag("italic").over(order))
        | (F.abs(F.col("size") - F.lag("size").over(order)) > 1)
        | F.coalesce(F.col("gap") > 1.6 * F.col("usual"), F.lit(False))
        | (F.col("x") - F.col("margin") > 6)
    )
    return rows.withColumn("para", F.sum(cut.cast("long")).over(order)).drop("gap", "usual", "margin")


def joined_paragraphs(lines: DataFrame, page: list[str]) -> DataFrame:
    """One row a paragraph; a hyphen at a line's end joins the next line without a space."""
    parts = F.array_sort(F.collect_list(F.struct("n", "text")))
    text = F.regexp_replace(F.array_join(F.transform(parts, lambda p: p["text"]), "\n"), "(?<=[a-z])-\n(?=[a-z])", "")
    return lines.groupBy(*page, "para").agg(F.count("*").alias("lines"), F.regexp_replace(text, "\n", " ").alias("text"))


def recurring_lines(paragraphs: DataFrame, share: float, least: int = 2) -> DataFrame:
    """line, pages: lines on max(least, share of all pages) pages or more."""
    rows = paragraphs.select("page", F.trim("text").alias("line"))
    total = rows.agg(F.countDistinct("page").alias("total")).scalar()
    counts = rows.groupBy("line").agg(F.countDistinct("page").alias("pages"))
    return counts.where(F.col("pages") >= F.greatest(F.lit(least), F.floor(total * F.lit(round(share * 1000)) / 1000)))


def without_furniture(paragraphs: DataFrame, recurring: DataFrame) -> DataFrame:
    return paragraphs.join(recurring.select(F.col("line").alias("__line")), F.trim("text") == F.col("__line"), "left_anti")


def bold_split(widths: DataFrame, page: list[str], ratio: float = 1.06, side: int = 3) -> DataFrame:
    """The threshold between regular and bold strokes: the cut of the sorted widths with the least variance within, by prefix sums."""
    order = Window.partitionBy(*page).orderBy("w", "n")
    whole = Window.partitionBy(*page)
    rows = widths.withColumn("i", F.row_number().over(order)).withColumn("total", F.count("*").over(whole))
    rows = rows.withColumn("s", F.sum("w").over(order)).withColumn("q", F.sum(F.col("w") * F.col("w")).over(order))
    rows = rows.withColumn("all_s", F.sum("w").over(whole)).withColumn("all_q", F.sum(F.col("w") * F.col("w")).over(whole)).withColumn("next", F.lead("w").over(order))
    right = F.col("total") - F.col("i")
    within = (F.col("q") - F.col("s") * F.col("s") / F.col("i")) + ((F.col("all_q") - F.col("q")) - (F.col("all_s") - F.col("s")) * (F.col("all_s") - F.col("s")) / right)
    rows = rows.where((F.col("i") >= side) & (right >= side)).withColumn("within", F.floor(within * 1000 + 0.5).cast("long"))
    best = rows.groupBy(*page).agg(F.min_by(F.struct("i", "s", "all_s", "total", "w", "next"), F.struct("within", "i")).alias("b"))
    low, high = F.col("b.s") / F.col("b.i"), (F.col("b.all_s") - F.col("b.s")) / (F.col("b.total") - F.col("b.i"))
    return best.where(high >= ratio * low).select(*page, ((F.col("b.w") + F.col("b.next")) / 2).alias("threshold"), F.col("b.i").cast("long").alias("regular"))


def padded_crops(boxes: DataFrame, pad: int = 10) -> DataFrame:
    """Boxes (x0, y0, x1, y1, page_w, page_h) widened by ``pad`` on every side, as far as the page goes: what a crop shows."""
    low = [F.greatest(F.lit(0), F.col(c) - pad).alias(c) for c in ("x0", "y0")]
    high = [F.least(F.col(size), F.col(c) + pad).alias(c) for c, size in (("x1", "page_w"), ("y1", "page_h"))]
    return boxes.select(*[F.col(c) for c in boxes.columns if c not in ("x0", "y0", "x1", "y1")], *low, *high)
