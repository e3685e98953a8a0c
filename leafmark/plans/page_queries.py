"""Queries over pages, readings, matching, units and evaluation.  Boxes and engines are simulated by arithmetic on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.legacy_font import to_unicode
from ..operators import evaluate as E
from ..operators import fusion as V
from ..operators import layout as L
from ..operators import lexicon as K
from ..operators import listing as G
from ..operators import matching as M
from ..operators import units as U
from ..operators.alignment import voted
from ..sources.tables import SQL, corpus_lines, paragraphs, table
from .text_queries import q


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return paragraphs(table(spark, sf, "documents"))


# Boxes: 40 px a line; the second engine's boxes drift and are sometimes missing or split.
_BOX = "(100 + para_no % 3 * 5)::INT AS x0, (para_no * 40)::INT AS y0, (1000 - para_no % 7 * 20)::INT AS x1, (para_no * 40 + 30)::INT AS y1"
_BOX2 = "(100 + para_no % 5 * 150)::INT AS x0, (para_no * 40 + para_no * 7 % 33 - 8)::INT AS y0, (1050 - para_no % 4 * 200)::INT AS x1, (para_no * 40 + para_no * 7 % 33 + 22 + para_no % 13 * 4)::INT AS y1"


def _boxes(spark: SparkSession, sf: str, box: str, keep: str = "true") -> DataFrame:
    exprs = ", ".join(box.replace("::INT", "").split(", "))
    rows = _lines(spark, sf).where(keep).selectExpr("page", "para_no AS n", *exprs.split(", "), "text")
    return rows.select("page", "n", *[F.col(c).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")], "text")


def box_overlap_join(spark: SparkSession, sf: str) -> DataFrame:
    return V.aligned(_boxes(spark, sf, _BOX), _boxes(spark, sf, _BOX2), ["page"]).select("page", "n", "text")


def orphan_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    return V.orphans(_boxes(spark, sf, _BOX, "para_no % 3 <> 0"), _boxes(spark, sf, _BOX2), ["page"]).select("page", "n")


def orphans_adopted(spark: SparkSession, sf: str) -> DataFrame:
    return V.adopted(V.orphans(_boxes(spark, sf, _BOX, "para_no % 3 <> 0"), _boxes(spark, sf, _BOX2), ["page"]), ["page"]).select("page", "n")


_ZTEXT = "CASE WHEN para_no % 17 = 3 THEN 'Page ' || page || ' of 530' WHEN para_no % 13 = 1 THEN '( ' || page || ' )' WHEN para_no % 19 = 18 THEN '1. ' || text WHEN para_no % 29 = 5 THEN '' ELSE text END"
_ZBOX = "para_no * 330 % 3300"


def zones(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.array(F.struct(F.lit(900).alias("x0"), F.lit(3200).alias("y0"), F.lit(1600).alias("x1"), F.lit(3300).alias("y1")))
    rows = _lines(spark, sf).selectExpr("page", "para_no AS n", "100 AS x0", f"cast({_ZBOX} AS int) AS y0", "cast(1000 + para_no % 3 AS int) AS x1", f"cast({_ZBOX} + CASE WHEN para_no % 10 > 6 THEN 20 ELSE 40 END AS int) AS y1", f"{_ZTEXT} AS text", "CASE WHEN page % 4 = 0 THEN 2800 END AS rule_y", "CASE WHEN para_no % 31 = 0 THEN 'header' END AS zone")
    rows = rows.withColumn("stamps", stamp).withColumn("page_h", F.lit(3300)).withColumn("page_w", F.lit(2560))
    return L.zones(rows, ["page"]).groupBy("page", "zone").agg(F.count("*").alias("n"), F.sum("n").alias("which"))


def gutter_histogram(spark: SparkSession, sf: str) -> DataFrame:
    words = _lines(spark, sf).selectExpr("page", "CASE WHEN page % 2 = 0 THEN 100 + para_no * 97 % 880 ELSE (para_no % 2) * 1300 + 100 + para_no * 53 % 700 END AS x")
    return L.quiet_bands(words, ["page"], 2560)


def two_columns(spark: SparkSession, sf: str) -> DataFrame:
    words = _lines(spark, sf).selectExpr("page", "CASE WHEN page % 2 = 0 THEN 100 + para_no * 97 % 2300 ELSE (para_no % 2) * 1300 + 100 + para_no * 53 % 700 END AS x")
    return L.gutters(words, ["page"], 2560, least_starts=10)


def paragraph_breaks(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).selectExpr("page", "para_no AS n", "para_no * 12 + CASE WHEN para_no % 6 = 0 THEN 9 ELSE 0 END AS y", "50 + CASE WHEN para_no % 5 = 0 THEN 10 ELSE 0 END AS x", "CASE WHEN para_no % 9 = 0 THEN 14 ELSE 10 END AS size", "para_no % 7 = 0 AS italic", "text")
    return L.paragraph_breaks(rows, ["page"]).select("page", "n", "para")


def joined_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).selectExpr("page", "para_no AS n", "CASE WHEN para_no % 2 = 0 THEN 'end-' ELSE 'start' END AS text", "para_no div 4 AS para")
    return L.joined_paragraphs(rows, ["page"])


def bold_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).selectExpr("page", "para_no AS n", "CASE WHEN para_no % 5 = 0 THEN 30 ELSE 20 END + para_no * 7 % 5 AS w")
    return L.bold_split(rows, ["page"]).select("page", F.floor(F.col("threshold") * 2).cast("long").alias("twice"), "regular")


_ENGINES = [("pivot", "text", 0.9, None), ("second", "translate(text, 'eo', 'co')", 0.8, 0.9), ("third", "translate(text, 'nt', 'nl')", 0.7, 0.5)]


def vote_majority(spark: SparkSession, sf: str) -> DataFrame:
    """Three readings of equal length: alignment is the identity."""
    readings = F.array(*[F.struct(X.characters(F.expr(e)).alias("items"), F.lit(w).alias("weight"), F.lit(c).cast("double").alias("conf")) for _, e, w, c in _ENGINES])
    got = V.positional_vote(_lines(spark, sf).select("page", F.col("para_no").alias("n"), readings.alias("readings")))
    return got.select("page", F.col("voters").cast("long").alias("voters"), "text", "same", "columns")


def vote_aligned(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of different lengths, aligned by edit scripts."""
    base = _lines(spark, sf)
    readings = F.array(*[F.struct(X.characters(e).alias("items"), F.lit(w).alias("weight"), F.lit(c).cast("double").alias("conf")) for e, w, c in ((F.col("text"), 0.9, None), (F.regexp_replace("text", "th", "t"), 0.8, 0.9), (F.regexp_replace("text", "e", "ee"), 0.7, 0.5))])
    return base.select("page", "para_no", readings.alias("r")).withColumn("v", voted("r")).select("page", "para_no", "v.text", "v.agreement", "v.n")


def cer_wer_by_engine(spark: SparkSession, sf: str) -> DataFrame:
    kinds = _lines(spark, sf).selectExpr("CASE WHEN para_no % 4 = 0 THEN 'heading' ELSE 'body' END AS kind", "text")
    rows = [kinds.selectExpr(f"'{name}' AS engine", "kind", "text AS ref", f"{e} AS hyp") for name, e, _, _ in _ENGINES]
    return E.error_rates(rows[0].unionByName(rows[1]).unionByName(rows[2])).select(F.coalesce("kind", F.lit("all")).alias("kind"), "engine", "lines", "edits", "chars", "word_edits", "words")


def eval_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return rows.groupingSets([["lang"], ["lang", "source"]], "lang", "source").agg(F.count("*").alias("n"), F.sum("quality").alias("good"))


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).selectExpr("page", "para_no AS n", "CASE para_no % 11 WHEN 0 THEN 'gurbani' WHEN 1 THEN 'gurbani-unmatched' ELSE 'commentary' END AS kind", "CASE WHEN para_no % 3 = 0 THEN NULL ELSE (page * 7 + para_no * 13) % 100 / 100.0D END AS agreement", "(page * 3 + para_no * 17) % 100 / 100.0D AS oov", "para_no % 9 AS n_words", "CASE WHEN para_no % 5 = 0 THEN NULL ELSE (page + para_no * 29) % 100 / 100.0D END AS conf", "CASE WHEN para_no % 8 = 7 THEN 'footnote' ELSE 'body' END AS zone", "(page + para_no) % 6 = 0 AS bad")
    return rows.withColumn("why", V.arbiter_reason(*[F.col(c) for c in ("kind", "agreement", "oov", "n_words", "conf")], lang="pa"))


def routing_cells(spark: SparkSession, sf: str) -> DataFrame:
    return E.routing_cells(_routed(spark, sf))


def routing_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf).groupBy(F.coalesce("why", F.lit("none")).alias("why")).agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))


def routed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return V.routed_pages(_routed(spark, sf), ["page"]).select("page", "body", "lines")


def match_quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).selectExpr("CASE page % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS engine", "CASE WHEN para_no % 2 = 0 THEN para_no END AS truth", "CASE WHEN para_no % 3 > 0 THEN para_no + CASE WHEN para_no % 7 = 0 THEN 1 ELSE 0 END END AS found")
    return E.match_quality(rows)


_ACC = [("pan", 0.958), ("script", 0.921), ("surya", 0.883), ("eng", 0.831), ("new", None)]


def voter_choice(spark: SparkSession, sf: str) -> DataFrame:
    acc = spark.createDataFrame(_ACC, "engine string, accuracy double")
    return V.voters(acc.select("engine"), acc, "surya")


def auto_weights(spark: SparkSession, sf: str) -> DataFrame:
    acc = spark.createDataFrame(_ACC, "engine string, accuracy double")
    return V.auto_weights(acc).select("engine", F.rint(F.col("weight") * 1000).cast("long").alias("weight_mil"))


def bake_off(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").selectExpr("lang", "'e' || cast(doc_id % 3 AS string) AS engine", "source AS book", "CASE WHEN doc_id % 3 = 0 THEN 0.95D ELSE 0.8D + (doc_id % 20) / 100.0D END AS accuracy")
    return E.bake_off(rows)


def _keyed(spark: SparkSession, sf: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    base = _lines(spark, sf).selectExpr("page * 100000 + para_no AS qid", f"{text} AS text")
    return base.select("qid", "text", M.match_key(F.col("text")).alias("key")), corpus_lines(table(spark, sf, "benchmark")).select("line_id", "ang", "text", M.match_key(F.col("text")).alias("key"))


def trigram_candidates_topk(spark: SparkSession, sf: str) -> DataFrame:
    queries, corpus = _keyed(spark, sf)
    return M.candidates(queries, corpus, 5)


def fuzzy_match(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that carry a corpus line: those whose best candidate shares most of its trigrams go on to alignment.

    Only the first 120 characters of a line are looked at: whole lines give pairs too dear to align (figures in the README).
    """
    queries, corpus = _keyed(spark, sf, "left(text, 120)")
    strong = M.candidates(queries, corpus, M.TOP).join(corpus.select("line_id", F.size("key").alias("size")), "line_id").where("hits * 2 >= size")
    return M.matched(queries, corpus, strong.select("qid", "line_id"), M.GLOBAL_ACCEPT, "global").select("qid", "line_id", "score", "method")


def correct_words(spark: SparkSession, sf: str) -> DataFrame:
    book = K.word_support(_lines(spark, sf), "text", 30).select("word")
    broken = book.select(F.translate("word", "eo", "ce").alias("word"), F.col("word").alias("truth")).where("word <> truth").join(book, "word", "left_anti")
    return K.corrections(broken, book, {"c>e": 0.3, "e>o": 0.4}).select("word", "best", "verdict")


def learned_confusions(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).select(X.characters(F.expr("translate(text, 'eo', 'co')")).alias("reading"), X.characters(F.col("text")).alias("truth"))
    return K.learned_confusions(rows).select("a", "b", "n")


def _records(spark: SparkSession, sf: str) -> DataFrame:
    style = "CASE role WHEN 'system' THEN 'heading' WHEN 'user' THEN 'quote' ELSE 'body' END"
    return table(spark, sf, "conversations").selectExpr("'w' || cast(conv_id % 20 AS string) AS work", "cast(conv_id % 3 AS string) AS part", "cast(conv_id AS long) AS page", "cast(turn AS long) AS para_no", f"{style} AS style", "coalesce(text, '') AS text", "cast(null AS string) AS text_src", f"CASE WHEN {style} = 'quote' THEN array(cast(conv_id % 7 AS string)) ELSE array() END AS cites")


def units_build(spark: SparkSession, sf: str) -> DataFrame:
    return U.numbered(U.build_units(_records(spark, sf), 60, 220)).select("unit_row", "work", "part", "page", "para_no", "words", F.md5("text").alias("text"))


def units_conserved(spark: SparkSession, sf: str) -> DataFrame:
    """With one unit a part, and prose in each, units keep all words: sums by work on both sides."""
    rec = _records(spark, sf).where("style = 'body'").where("size(split(trim(text), ' +')) >= 3")
    units = U.build_units(rec, 10**9, 10**9)
    return units.groupBy("work").agg(F.sum("words").alias("words"))


def apply_translation(spark: SparkSession, sf: str) -> DataFrame:
    conv = table(spark, sf, "conversations").selectExpr("concat(conv_id, ':', turn) AS unit_id", "conv_id", "turn", "role", "text")
    rows = conv.selectExpr("unit_id", "CASE role WHEN 'user' THEN 'quote' ELSE 'body' END AS style", "text", "CASE WHEN conv_id % 2 = 0 THEN 'en' ELSE 'pa' END AS lang")
    done = conv.where("turn % 2 = 0").selectExpr("unit_id", "'en:' || text AS en")
    return U.apply_translations(rows, done).select("unit_id", "style", F.md5("text").alias("text"), F.md5("text_src").alias("text_src"), "lang")


def ingest_measure(spark: SparkSession, sf: str) -> DataFrame:
    return E.ingest_measure(_lines(spark, sf).selectExpr("CASE WHEN para_no % 11 = 0 THEN 'quote' WHEN para_no % 13 = 0 THEN 'heading' ELSE 'body' END AS style", "CASE WHEN para_no % 22 = 0 THEN text || ' 921' ELSE text END AS text"))


def mode_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return V.first_seen_mode(table(spark, sf, "documents"), ["source"], "lang", "doc_id")


def upper_median(spark: SparkSession, sf: str) -> DataFrame:
    return V.upper_median(table(spark, sf, "documents").select("source", "n_chars"), ["source"], "n_chars")


def p10_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return V.low_tenth(table(spark, sf, "documents").select("lang", "n_chars"), ["lang"], "n_chars")


def listing_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "documents").selectExpr("source AS author", "doc_id AS work", "'old' AS state")
    new = old.where("author IN ('src1', 'src2') AND work % 2 = 0").withColumn("state", F.lit("new"))
    return G.replace_group(old, new, "author")


def promote_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "labels").selectExpr("doc_id AS id", "quality AS v", "'old' AS state")
    new = table(spark, sf, "documents").where("doc_id % 5 = 0").selectExpr("doc_id AS id", "cast(doc_id % 2 AS int) AS v", "'new' AS state")
    return G.upsert(old, new, "id")


def resume_todo(spark: SparkSession, sf: str) -> DataFrame:
    todo = table(spark, sf, "documents").where("lang <> 'en'").selectExpr("cast(doc_id AS string) AS unit_id")
    done = table(spark, sf, "labels").selectExpr("concat(doc_id, '#c', quality) AS id")
    return G.remaining(todo, done, "unit_id", "id")


_FILES = [("A-One.pdf", None, None), ("b two.pdf", "public-domain", None), ("C_3.pdf", "cc", "verbatim"), ("d.pdf", None, "hold")]


def manifest_defaults(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.tables import MANIFEST, sources

    works = [{"file": f, "licence": lic, "quote_policy": p} for f, lic, p in _FILES]
    return sources(spark.createDataFrame([{"author": "someone", "works": works}], MANIFEST)).select("file", "work", "title", "author", "language", "licence", "quote_policy")


#: Keystrokes and what they spell.
TYPED = [
    ("0123456789!?()'‘’:/", "੦੧੨੩੪੫੬੭੮੯!?()'‘’:/"), ("rzw b^So rwizk irhwko rhIm ]1]", "ਰਜ਼ਾ ਬਖ਼ਸ਼ੋ ਰਾਜ਼ਿਕ ਰਿਹਾਕੋ ਰਹੀਮ ॥੧॥"), ("<> siqgur pRswid ]", "ੴ ਸਤਿਗੁਰ ਪ੍ਰਸਾਦਿ ॥"),
    ("1Eå siqgur pRswid ]", "ੴ ਸਤਿਗੁਰ ਪ੍ਰਸਾਦਿ ॥"), ("hUM", "ਹੂੰ"), ("El@w", "ਓਲੑਾ"), ("aulwm@y", "ਉਲਾਮੑੇ"), ("suohwgix", "ਸੋੁਹਾਗਣਿ"), ("clwey", "ਚਲਾਏ"), ("AOr", "ਔਰ"),
    ("lweIAW", "ਲਾਈਆਂ"), ("ny Awein guil gulSin &¤ro zyb", "ਨੇ ਆੲਨਿ ਗੁਲਿ ਗੁਲਸ਼ਨਿ ਫ਼ੱਰੋ ਜ਼ੇਬ"), ("AMimRq vylw scu nwau vifAweI vIcwru ]", "ਅੰਮ੍ਰਿਤ ਵੇਲਾ ਸਚੁ ਨਾਉ ਵਡਿਆਈ ਵੀਚਾਰੁ ॥"),
    ("sMiDAw pRwq ies˜wnu krwhI ]", "ਸੰਧਿਆ ਪ੍ਰਾਤ ਇਸ੍ਨਾਨੁ ਕਰਾਹੀ ॥"), ("ik®s˜w qy jwnaU hir hir nwcMqI nwcnw ]1]", "ਕ੍ਰਿਸ੍ਨਾ ਤੇ ਜਾਨਊ ਹਰਿ ਹਰਿ ਨਾਚੰਤੀ ਨਾਚਨਾ ॥੧॥"), ("kW@n", "ਕੑਾਂਨ"),
    ("slok mÚ 3 ]", "ਸਲੋਕ ਮਃ ੩ ॥"), ("6 : sMgq dw Asr-nwn`qÍ", "੬ : ਸੰਗਤ ਦਾ ਅਸਰ-ਨਾਨੱਤ੍ਵ"),
]


def legacy_font(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t, _ in TYPED], "typed string").select("typed", to_unicode(F.col("typed")).alias("text"))


def filename_parse(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.filenames import parsed

    tails = table(spark, sf, "pages").select("page_id", F.expr("CASE page_id % 5 WHEN 0 THEN lpad(cast(page_id AS string), 10, '2') || '014-Some_Title-Part-2_edit_' || page_id WHEN 1 THEN 'Lekh_' || page_id || '_Divine-Wil' WHEN 2 THEN lpad(cast(page_id AS string), 10, '3') || 'Lekh-7-Hukum_SS_final' WHEN 3 THEN lpad(cast(page_id AS string), 10, '4') || 'Plain Name' ELSE 'Universal-Religion' END").alias("name"))
    return tails.select("page_id", "name", parsed(F.col("name")).alias("p")).select("page_id", "p.*")


def padded_crops(spark: SparkSession, sf: str) -> DataFrame:
    rows = _boxes(spark, sf, _BOX).withColumn("page_w", F.lit(1000)).withColumn("page_h", F.lit(3300))
    return L.padded_crops(rows).select("page", "n", "x0", "y0", "x1", "y1")


_STYLE = "CASE para_no % 4 WHEN 0 THEN 'quote' WHEN 1 THEN 'prose' ELSE 'body' END AS style"
_BENCH_TEXT = "CASE WHEN para_no % 6 = 5 THEN text || ' ॥' ELSE text || '  ' END AS text"


def bench_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).selectExpr("page", "para_no AS n", _STYLE, "CASE WHEN para_no % 5 <> 0 THEN lang END AS lang", _BENCH_TEXT)
    return E.bench_lines(rows, ["prose", "body"], "pa").select("page", "n", F.md5("text").alias("text"))


# Angles are 64ths, so that sums are exact in any order.
_ANGLE = "CASE WHEN doc_id % 9 <> 4 THEN (doc_id * 37 % 401 - 200) / 64.0{0} END AS angle, CASE WHEN doc_id % 5 <> 0 THEN doc_id % 7 = 0 END AS skipped"


def render_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").selectExpr("source AS book", *_ANGLE.format("D").split(", "))
    got = E.render_report(rows)
    return got.select("book", "rendered", "there", F.floor(F.col("mean_angle") * 1000).cast("long").alias("mean_mil"), F.floor(F.col("max_angle") * 1000).cast("long").alias("max_mil"))


_OUTPUT = "CASE doc_id % 4 WHEN 0 THEN 'merged' WHEN 1 THEN 'ink' WHEN 2 THEN 'glyph' ELSE 'vision' END AS engine"


def _outputs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr("source AS book", "doc_id % 50 AS page", _OUTPUT)


def engines_with_output(spark: SparkSession, sf: str) -> DataFrame:
    return G.engines_with_output(_outputs(spark, sf)).select("book", F.array_join("engines", ",").alias("engines"))


def missing_runs(spark: SparkSession, sf: str) -> DataFrame:
    truth = table(spark, sf, "documents").selectExpr("source AS book", "doc_id % 60 AS page")
    return G.missing_runs(truth, _outputs(spark, sf), {"ink": False, "glyph": False, "vision": True})


def queries() -> dict:
    names = ("box_overlap_join orphan_anti_join orphans_adopted zones gutter_histogram two_columns paragraph_breaks joined_paragraphs bold_split vote_majority vote_aligned cer_wer_by_engine eval_grouping_sets "
             "routing_cells routing_reasons routed_pages match_quality voter_choice auto_weights bake_off trigram_candidates_topk fuzzy_match correct_words learned_confusions units_build units_conserved apply_translation "
             "ingest_measure mode_first_seen upper_median p10_agreement listing_upsert promote_upsert resume_todo manifest_defaults legacy_font filename_parse "
             "padded_crops bench_lines render_report engines_with_output missing_runs").split()  # fmt: skip
    return {n: globals()[n] for n in names}


def _share(a0: str, a1: str, b0: str, b1: str) -> str:
    return f"greatest(0, least({a1}, {b1}) - greatest({a0}, {b0})) / greatest(1, least({a1} - {a0}, {b1} - {b0}))::DOUBLE"


def oracle_sql() -> dict[str, str]:
    a, b = (f"SELECT page, para_no AS n, {box}, text FROM paras" for box in (_BOX, _BOX2))
    v, h = _share("p.y0", "p.y1", "o.y0", "o.y1"), _share("p.x0", "p.x1", "o.x0", "o.x1")
    votes = " UNION ALL ".join(f"SELECT page, para_no AS n, {i} AS rank, {w * (0.8 if c is None else c) + (1e-6 if i == 0 else 0)} AS w, {e} AS t FROM paras" for i, (_, e, w, c) in enumerate(_ENGINES))
    why = """CASE WHEN kind = 'gurbani' THEN NULL WHEN kind = 'gurbani-unmatched' THEN 'unmatched-bold' WHEN agreement < 0.85 THEN 'low-agreement'
        WHEN oov > 0.25 AND n_words >= 4 THEN 'oov' WHEN conf < 0.5 THEN 'low-conf' END"""
    routed = f"""{SQL}, r AS (SELECT page, para_no AS n, CASE para_no % 11 WHEN 0 THEN 'gurbani' WHEN 1 THEN 'gurbani-unmatched' ELSE 'commentary' END AS kind, CASE WHEN para_no % 3 <> 0 THEN (page * 7 + para_no * 13) % 100 / 100.0::DOUBLE END AS agreement,
        (page * 3 + para_no * 17) % 100 / 100.0::DOUBLE AS oov, para_no % 9 AS n_words, CASE WHEN para_no % 5 <> 0 THEN (page + para_no * 29) % 100 / 100.0::DOUBLE END AS conf, CASE WHEN para_no % 8 = 7 THEN 'footnote' ELSE 'body' END AS zone, (page + para_no) % 6 = 0 AS bad FROM paras),
        w AS (SELECT *, {why} AS why FROM r)"""
    acc = "a AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', {x if x is not None else 'NULL'}::DOUBLE)" for n, x in _ACC) + ") v(engine, accuracy))"
    key = "regexp_replace(trim(regexp_replace({0}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), '[^A-Za-z0-9]', '', 'g')"
    style = "CASE role WHEN 'system' THEN 'heading' WHEN 'user' THEN 'quote' ELSE 'body' END"
    files = ", ".join(f"({i}, '{f}', {q(lic) if lic else 'NULL'}, {q(p) if p else 'NULL'})" for i, (f, lic, p) in enumerate(_FILES))
    rank = "row_number() OVER (PARTITION BY {0} ORDER BY n_chars) AS r, count(*) OVER (PARTITION BY {0}) AS n"

    return {
        "padded_crops": f"WITH {SQL}, b AS ({a}) SELECT page, n, greatest(0, x0 - 10) AS x0, greatest(0, y0 - 10) AS y0, least(1000, x1 + 10) AS x1, least(3300, y1 + 10) AS y1 FROM b",
        "bench_lines": rf"""WITH {SQL}, r AS (SELECT page, para_no AS n, {_STYLE}, CASE WHEN para_no % 5 <> 0 THEN lang END AS lang, {_BENCH_TEXT} FROM paras)
            SELECT page, n, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS text FROM r WHERE style IN ('prose', 'body') AND coalesce(lang, 'pa') <> 'en' AND length(text) >= 40 AND NOT contains(text, '॥')""",
        "render_report": f"""WITH r AS (SELECT source AS book, {_ANGLE.format('::DOUBLE')} FROM documents), d AS (SELECT book, NOT coalesce(skipped, false) AS done, abs(coalesce(angle, 0)) AS angle FROM r)
            SELECT book, count(*) FILTER (done) AS rendered, count(*) FILTER (NOT done) AS there, floor(coalesce(avg(angle) FILTER (done), 0) * 1000)::BIGINT AS mean_mil, floor(coalesce(max(angle) FILTER (done), 0) * 1000)::BIGINT AS max_mil FROM d GROUP BY book""",
        "engines_with_output": f"WITH o AS (SELECT DISTINCT source AS book, {_OUTPUT} FROM documents) SELECT book, string_agg(engine, ',' ORDER BY engine = 'merged', engine) AS engines FROM o GROUP BY book",
        "missing_runs": f"""WITH o AS (SELECT source AS book, doc_id % 50 AS page, {_OUTPUT} FROM documents), t AS (SELECT DISTINCT source AS book, doc_id % 60 AS page FROM documents),
            e AS (SELECT * FROM (VALUES ('ink', true), ('glyph', true), ('vision', false)) AS v(engine, run)) SELECT book, page, engine, run FROM t, e WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.book = t.book AND o.page = t.page AND o.engine = e.engine)""",
        "box_overlap_join": f"WITH {SQL}, p AS ({a}), o AS ({b}) SELECT page, p.n AS n, trim(string_agg(o.text, ' ' ORDER BY o.x0, o.n)) AS text FROM p JOIN o USING (page) WHERE {v} >= 0.5 AND {h} >= 0.3 GROUP BY page, p.n",
        "orphan_anti_join": f"""WITH {SQL}, p AS ({a} WHERE para_no % 3 <> 0), o AS ({b}), u AS (SELECT page, list_sort(list(y1 - y0))[(count(*) // 2 + 1)::INT] AS usual FROM p GROUP BY page)
            SELECT page, o.n AS n FROM o JOIN u USING (page) WHERE o.y1 - o.y0 <= 2.5 * usual AND NOT EXISTS (SELECT 1 FROM p WHERE p.page = o.page AND {v} >= 0.4)""",
        "zones": f"""WITH {SQL}, l AS (SELECT page, para_no AS n, 100 AS x0, ({_ZBOX})::INT AS y0, (1000 + para_no % 3)::INT AS x1, ({_ZBOX} + CASE WHEN para_no % 10 > 6 THEN 20 ELSE 40 END)::INT AS y1, {_ZTEXT} AS text, CASE WHEN page % 4 = 0 THEN 2800 END AS rule_y, CASE WHEN para_no % 31 = 0 THEN 'header' END AS zone FROM paras),
            s AS (SELECT *, list_sort(list(CASE WHEN trim(text) <> '' THEN y1 - y0 END) FILTER (trim(text) <> '') OVER (PARTITION BY page)) AS hs FROM l),
            z AS (SELECT page, n, y0, y1, text, rule_y, coalesce(hs[(len(hs) // 2 + 1)::INT], 0) AS body_h, CASE WHEN zone IS NOT NULL THEN zone WHEN trim(text) = '' THEN 'body'
                WHEN regexp_matches(trim(text), '{X.STAMP}') OR regexp_matches(trim(text), '{X.STAMP_WORD}') OR (length(trim(text)) < 40 AND regexp_matches(trim(text), '{X.STAMP_ANY}'))
                  OR greatest(0, least(x1, 1600) - greatest(x0, 900)) * greatest(0, least(y1, 3300) - greatest(y0, 3200)) >= 0.5 * greatest(1, (x1 - x0) * (y1 - y0)) THEN 'stamp'
                WHEN regexp_matches(trim(text), '{X.PAGE_NUMBER}') AND ((y0 + y1) / 2.0 < 3300 * 0.1125 OR (y0 + y1) / 2.0 > 3300 * 0.91) THEN 'pageno'
                WHEN (y0 + y1) / 2.0 < 3300 * 0.075 AND length(trim(text)) <= 90 THEN 'header' WHEN y0 > rule_y THEN 'footnote' ELSE 'body' END AS zone FROM s),
            t AS (SELECT *, zone = 'body' AND rule_y IS NULL AND body_h > 0 AND sum(CASE WHEN y1 - y0 < body_h * 0.85 THEN 0 ELSE 1 END) OVER (PARTITION BY page, zone ORDER BY y0 DESC, n DESC) = 0 AS tail FROM z),
            f AS (SELECT *, min(CASE WHEN tail AND regexp_matches(text, '{X.FOOTNOTE_START}') THEN y0::BIGINT * 1000000 + n END) OVER (PARTITION BY page) AS first FROM t)
            SELECT page, CASE WHEN tail AND y0::BIGINT * 1000000 + n >= first THEN 'footnote' ELSE zone END AS zone, count(*) AS n, sum(n)::BIGINT AS which FROM f GROUP BY ALL""",
        "gutter_histogram": f"""WITH {SQL}, w AS (SELECT page, CASE WHEN page % 2 = 0 THEN 100 + para_no * 97 % 880 ELSE (para_no % 2) * 1300 + 100 + para_no * 53 % 700 END AS x FROM paras),
            h AS (SELECT page, x // 8 AS bin, count(*) AS c FROM w GROUP BY ALL), t AS (SELECT page, count(*) AS total FROM w GROUP BY page), g AS (SELECT page, total, unnest(range(384 // 8, 2176 // 8 + 1)) AS bin FROM t),
            f AS (SELECT g.page, g.bin, coalesce(c, 0) <= total // 400 AS quiet FROM g LEFT JOIN h ON h.page = g.page AND h.bin = g.bin), i AS (SELECT *, sum(CASE WHEN quiet THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY bin) AS isle FROM f),
            b AS (SELECT page, min(bin) * 8 AS lo, (max(bin) + 1) * 8 AS hi FROM i WHERE quiet GROUP BY page, isle)
            SELECT page, lo, hi FROM b QUALIFY row_number() OVER (PARTITION BY page ORDER BY hi - lo DESC, lo) = 1""",
        "paragraph_breaks": f"""WITH {SQL}, l AS (SELECT page, para_no AS n, para_no * 12 + CASE WHEN para_no % 6 = 0 THEN 9 ELSE 0 END AS y, 50 + CASE WHEN para_no % 5 = 0 THEN 10 ELSE 0 END AS x, CASE WHEN para_no % 9 = 0 THEN 14 ELSE 10 END AS size, para_no % 7 = 0 AS italic FROM paras),
            g AS (SELECT *, y - lag(y) OVER w AS gap, lag(n) OVER w AS pn, lag(italic) OVER w AS pi, lag(size) OVER w AS ps, min(x) OVER (PARTITION BY page) AS margin FROM l WINDOW w AS (PARTITION BY page ORDER BY n)),
            u AS (SELECT page, quantile_cont(gap, 0.5) AS usual FROM g WHERE gap > 0 GROUP BY page)
            SELECT g.page, n, sum((pn IS NULL OR italic <> pi OR abs(size - ps) > 1 OR coalesce(gap > 1.6 * usual, false) OR x - margin > 6)::INT) OVER (PARTITION BY g.page ORDER BY n)::BIGINT AS para FROM g LEFT JOIN u ON u.page = g.page""",
        "joined_paragraphs": f"""WITH {SQL}, j AS (SELECT page, para_no // 4 AS para, count(*) AS lines, string_agg(CASE WHEN para_no % 2 = 0 THEN 'end-' ELSE 'start' END, chr(10) ORDER BY para_no) AS t FROM paras GROUP BY ALL)
            SELECT page, para, lines, replace(replace(t, 'd-' || chr(10) || 's', 'ds'), chr(10), ' ') AS text FROM j""",
        "bold_split": f"""WITH {SQL}, w AS (SELECT page, para_no AS n, CASE WHEN para_no % 5 = 0 THEN 30 ELSE 20 END + para_no * 7 % 5 AS w FROM paras),
            c AS (SELECT *, row_number() OVER o AS i, count(*) OVER p AS total, sum(w) OVER o AS s, sum(w * w) OVER o AS q, sum(w) OVER p AS ss, sum(w * w) OVER p AS qq, lead(w) OVER o AS nxt FROM w WINDOW o AS (PARTITION BY page ORDER BY w, n), p AS (PARTITION BY page)),
            v AS (SELECT *, floor(((q - s * s / i::DOUBLE) + ((qq - q) - (ss - s) * (ss - s) / (total - i)::DOUBLE)) * 1000 + 0.5)::BIGINT AS within FROM c WHERE i >= 3 AND total - i >= 3),
            b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY page ORDER BY within, i) = 1)
            SELECT page, (w + nxt)::BIGINT AS twice, i AS regular FROM b WHERE (ss - s) / (total - i)::DOUBLE >= 1.06 * (s / i::DOUBLE)""",
        "vote_majority": f"""WITH {SQL}, r AS ({votes}), c AS (SELECT page, n, rank, w, unnest(string_split(t, '')) AS g, generate_subscripts(string_split(t, ''), 1) AS i FROM r),
            b AS (SELECT page, n, i, g, round(sum(w), 9) AS w, count(*) AS votes, min(rank) AS first FROM c GROUP BY ALL), x AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY page, n, i ORDER BY w DESC, first) = 1)
            SELECT page, 3::BIGINT AS voters, string_agg(g, '' ORDER BY i) AS text, count(*) FILTER (votes = 3) AS same, count(*) AS columns FROM x GROUP BY page, n""",
        "eval_grouping_sets": "SELECT lang, source, count(*) AS n, sum(quality)::BIGINT AS good FROM documents JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang), (lang, source))",
        "routing_cells": f"WITH {routed} SELECT count(*) FILTER (why IS NOT NULL AND bad) AS caught, count(*) FILTER (why IS NOT NULL AND NOT bad) AS needless, count(*) FILTER (why IS NULL AND bad) AS missed, count(*) FILTER (why IS NULL AND NOT bad) AS fine FROM w",
        "routing_reasons": f"WITH {routed} SELECT coalesce(why, 'none') AS why, count(*) AS n, count(*) FILTER (bad) AS bad FROM w GROUP BY ALL",
        "routed_pages": f"""WITH {routed}, g AS (SELECT page, count(*) AS body, count(*) FILTER (why IS NOT NULL AND why <> 'unmatched-bold') AS lines, count(why) AS doubtful FROM w WHERE zone = 'body' GROUP BY page)
            SELECT page, body, lines FROM g WHERE doubtful > 0 AND (lines >= 3 OR lines / body::DOUBLE >= 0.15)""",
        "match_quality": f"""WITH {SQL}, r AS (SELECT CASE page % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS engine, CASE WHEN para_no % 2 = 0 THEN para_no END AS truth, CASE WHEN para_no % 3 > 0 THEN para_no + CASE WHEN para_no % 7 = 0 THEN 1 ELSE 0 END END AS found FROM paras),
            c AS (SELECT engine, count(*) FILTER (truth = found) AS "right", count(*) FILTER (truth <> found) AS wrong, count(*) FILTER (truth IS NOT NULL AND found IS NULL) AS "none", count(*) FILTER (truth IS NULL AND found IS NOT NULL) AS "false" FROM r GROUP BY engine)
            SELECT *, "right" * 1000000 // greatest("right" + wrong + "false", 1) AS precision_ppm, "right" * 1000000 // greatest("right" + wrong + "none", 1) AS recall_ppm FROM c""",
        "voter_choice": f"WITH {acc} SELECT engine FROM a WHERE engine = 'surya' OR accuracy IS NULL OR accuracy >= 0.9",
        "auto_weights": f"WITH {acc} SELECT engine, CASE WHEN accuracy IS NULL THEN 500 ELSE round_even(pow(accuracy, 4) * 1000, 0)::BIGINT END AS weight_mil FROM a",
        "bake_off": "SELECT lang, 'e' || doc_id % 3 AS engine, bool_and(CASE WHEN doc_id % 3 = 0 THEN 0.95 ELSE 0.8::DOUBLE + (doc_id % 20) / 100.0::DOUBLE END >= 0.9::DOUBLE) AS chosen, count(*) AS books FROM documents GROUP BY ALL",
        "trigram_candidates_topk": f"""WITH {SQL}, k AS (SELECT page * 100000 + para_no AS qid, {key.format('text')} AS k FROM paras), l AS (SELECT line_id, {key.format('text')} AS k FROM lines),
            qg AS (SELECT qid, k[i:i+2] AS g FROM (SELECT qid, k, unnest(range(1, greatest(length(k) - 1, 1))) AS i FROM k) WHERE length(k) >= 3), lg AS (SELECT DISTINCT line_id, k[i:i+2] AS g FROM (SELECT line_id, k, unnest(range(1, greatest(length(k) - 1, 1))) AS i FROM l) WHERE length(k) >= 3),
            h AS (SELECT qid, line_id, count(*) AS hits FROM qg JOIN lg USING (g) GROUP BY ALL) SELECT qid, line_id, hits FROM h QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hits DESC, line_id) <= 5""",
        "units_conserved": f"""WITH r AS (SELECT 'w' || conv_id % 20 AS work, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w, text FROM conversations WHERE {style} = 'body')
            SELECT work, sum(len(w))::BIGINT AS words FROM r WHERE len(regexp_split_to_array(trim(text), ' +')) >= 3 GROUP BY work""",
        "apply_translation": """WITH c AS (SELECT conv_id || ':' || turn AS unit_id, CASE role WHEN 'user' THEN 'quote' ELSE 'body' END AS style, text, CASE WHEN conv_id % 2 = 0 THEN 'en' ELSE 'pa' END AS lang, CASE WHEN turn % 2 = 0 THEN 'en:' || text END AS en FROM conversations),
            p AS (SELECT *, style = 'quote' OR lang = 'en' AS passes FROM c) SELECT unit_id, style, md5(CASE WHEN passes THEN text ELSE en END) AS text, md5(CASE WHEN NOT passes THEN text END) AS text_src, CASE WHEN passes THEN lang ELSE 'en' END AS lang FROM p WHERE passes OR en IS NOT NULL""",
        "ingest_measure": f"""WITH {SQL}, r AS (SELECT CASE WHEN para_no % 11 = 0 THEN 'quote' WHEN para_no % 13 = 0 THEN 'heading' ELSE 'body' END AS style, CASE WHEN para_no % 22 = 0 THEN text || ' 921' ELSE text END AS text FROM paras)
            SELECT count(*) AS paragraphs, count(*) FILTER (style = 'body') AS body, count(*) FILTER (style = 'quote') AS quotes, count(*) FILTER (style = 'heading') AS headings, sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')))::BIGINT AS words,
            sum(len(regexp_extract_all(text, '[a-z][A-Z]')))::BIGINT AS glue_defects, count(*) FILTER (style = 'body' AND length(text) > 40 AND NOT regexp_matches(text, '[.!?:;"”’)।॥–—]\\s*$')) AS body_mid_sentence,
            count(*) FILTER (style = 'quote' AND try_cast(regexp_extract(text, '([0-9]{{2,4}})\\s*[^0-9]{{0,24}}$', 1) AS INT) BETWEEN 62 AND 1430) AS quotes_with_ang FROM r""",
        "mode_first_seen": "SELECT source, lang FROM (SELECT source, lang, count(*) AS c, min(doc_id) AS f FROM documents GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY source ORDER BY c DESC, f) = 1",
        "upper_median": f"SELECT source, n_chars AS median FROM (SELECT source, n_chars, {rank.format('source')} FROM documents) WHERE r = n // 2 + 1",
        "p10_agreement": f"SELECT lang, n_chars AS p10 FROM (SELECT lang, n_chars, {rank.format('lang')} FROM documents) WHERE r = n // 10 + 1",
        "listing_upsert": "WITH o AS (SELECT source AS author, doc_id AS work, 'old' AS state FROM documents), n AS (SELECT author, work, 'new' AS state FROM o WHERE author IN ('src1', 'src2') AND work % 2 = 0) SELECT * FROM o WHERE author NOT IN (SELECT author FROM n) UNION ALL SELECT * FROM n",
        "promote_upsert": "WITH n AS (SELECT doc_id AS id, (doc_id % 2)::INT AS v, 'new' AS state FROM documents WHERE doc_id % 5 = 0) SELECT doc_id AS id, quality AS v, 'old' AS state FROM labels WHERE doc_id NOT IN (SELECT id FROM n) UNION ALL SELECT * FROM n",
        "resume_todo": "SELECT doc_id::VARCHAR AS unit_id FROM documents WHERE lang <> 'en' AND doc_id NOT IN (SELECT doc_id FROM labels)",
        "manifest_defaults": f"""SELECT file, regexp_replace(regexp_replace(lower(regexp_replace(file, '\\.[A-Za-z0-9]+$', '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS work, regexp_replace(file, '\\.[A-Za-z0-9]+$', '') AS title, 'someone' AS author, 'en' AS language,
            coalesce(licence, 'unknown') AS licence, coalesce(policy, CASE WHEN licence = 'public-domain' THEN 'verbatim' ELSE 'summarise' END) AS quote_policy FROM (VALUES {files}) v(n, file, licence, policy)""",
        "legacy_font": "SELECT * FROM (VALUES " + ", ".join(f"({q(t)}, {q(u)})" for t, u in TYPED) + ") v(typed, text)",
    }
