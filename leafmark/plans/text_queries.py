"""Queries over text functions, vocabularies and translation checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..operators import lexicon as L
from ..sources.tables import SQL, paragraphs, table

#: Lines in the scripts that no table carries.
SAMPLES = [
    "ਿਕਰਪਾ ਕਰਿ ਕੈ", "ਅਾਪਣਾ ਲ਼ਾਲ ਖ਼ਾਲਸਾ", "ੲਿਕੁ  ਓਅੰਕਾਰੁ", "ਸਤਿਿ ਨਾਮੁੁ ॥੧॥", "‘quoted’ “twice” `x´", "देवनागरी पाठ", "mixed ਪੰਜਾਬੀ text",
    "12 34", "zero​width­soft", "ਪੰਨਾ ੧੨-੧੪ ( ੧੮੩ )", "Page 8 of 530", "ਸ਼ਬਦ੧ tail12 1999", "", "ੳੁਪਰ ੳੂਠ ੲੀਸ਼ਵਰ ੲੇਕ ਅੈਸਾ ਅੌਖਾ",
]


def _samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, t in enumerate(SAMPLES)], "n long, text string")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return paragraphs(table(spark, sf, "documents"))


def normalise_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).select((F.col("page") * 100_000 + F.col("para_no")).alias("n"), F.concat(F.lit("“"), "text", F.lit("​ `"))
                                    .alias("text"))
    return rows.unionByName(_samples(spark).withColumn("n", -1 - F.col("n"))).select("n", X.normalise(F.col("text")).alias("norm"))


def script_of(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).select("text").unionByName(_samples(spark).select("text"))
    return rows.groupBy(X.script_of(F.col("text")).alias("script")).agg(F.count("*").alias("n"))


def word_split(spark: SparkSession, sf: str) -> DataFrame:
    w = X.words(F.col("text"))
    return _lines(spark, sf).select("page", "para_no", F.size(w).cast("long").alias("n"), F.array_join(w, "|").alias("words"))


def footnote_markers(spark: SparkSession, sf: str) -> DataFrame:
    words = _lines(spark, sf).select("para_no", F.explode(X.words(F.col("text"))).alias("word"))
    words = words.select(F.concat("word", (F.col("para_no") % 130).cast("string")).alias("word")).distinct()
    m = X.footnote_marker(F.col("word"))
    return words.select("word", m["word"].alias("bare"), m["marker"].alias("marker"))


def slugs(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select("page", "para_no", X.slug(F.col("text")).alias("slug"))


def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    s = X.sentences(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(s).cast("long").alias("n"), F.try_element_at(s, F.lit(1)).alias("first"), F.try_element_at(s, F.lit(-1)).alias("last"))


def stamps(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).select("page", "para_no", F.expr("CASE para_no % 5 WHEN 0 THEN 'Page ' || para_no || ' of 530' WHEN 1 THEN 'www.site.example' WHEN 2 THEN '- x - ! page 8 of 530' ELSE text END").alias("text"))
    return rows.select("page", "para_no", X.is_stamp(F.col("text")).alias("stamp"))


def header_hints(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).select("page", "para_no", F.expr("CASE para_no % 4 WHEN 0 THEN text || ' (' || page || ') ਪੰਨਾ ' || para_no || '-' || (para_no + page % 3 - 1) WHEN 1 THEN text || ' ' || page WHEN 2 THEN 'ਪੰਨਾ ੧੨' ELSE '' END").alias("text"))
    h = X.header_hints(F.col("text"))
    return rows.select("page", "para_no", *[h[k].alias(k) for k in ("ang_from", "ang_to", "book_page", "section")])


def strip_html_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of engines that return HTML: plain text, cut into lines of equal height."""
    pages = table(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r"(?s)<p(?:\s[^>]*)?>.*?</p>"), F.lit(0))).alias("block"))
    plain = pages.groupBy("page_id").agg(F.count("*").alias("blocks"), F.sum(F.length(X.plain_html(F.col("block")))).alias("chars"))
    return plain


def split_blocks(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.layout import split_block

    blocks = table(spark, sf, "documents").select("doc_id", F.lit(100).alias("x0"), (F.col("doc_id") % 50).cast("int").alias("y0"), F.lit(900).alias("x1"), F.lit(1000).alias("y1"), "text")
    return split_block(blocks, ["doc_id"]).select("doc_id", "n", "y0", "y1", F.md5("text").alias("line"))


def translation_check(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn and the next as source and translation."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf, "conversations").withColumn("next", F.lead("text").over(w))
    return rows.select("conv_id", "turn", X.translation_fault(F.col("text"), F.col("next")).alias("fault"))


def repeated_windows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.repeats(F.col("text")).alias("repeats"))


def word_support(spark: SparkSession, sf: str) -> DataFrame:
    return L.word_support(_lines(spark, sf), "text", 3)


_SIMULATED = ["text", "translate(text, 'eo', 'ce')", "CASE WHEN para_no % 3 = 0 THEN translate(text, 'n', 'm') ELSE text END"]


def book_vocab(spark: SparkSession, sf: str) -> DataFrame:
    readings = F.array(*[F.expr(e) for e in _SIMULATED])
    return L.book_vocab(_lines(spark, sf).select("page", "para_no", readings.alias("readings")), ["page", "para_no"])


def oov_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Words against those of benchmark and those that three or more lines of documents support."""
    known = L.word_support(paragraphs(table(spark, sf, "benchmark").select(F.lit("b").alias("source"), F.col("item_id").alias("doc_id"), F.lit("").alias("lang"), "text")), "text", 1)
    known = known.select("word").unionByName(word_support(spark, sf).where("n >= 20").select("word")).distinct()
    return L.oov(_lines(spark, sf), ["page", "para_no"], known).select("page", "para_no", "n_words", "n_unknown")


def recurring_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines on many pages: heads and stamps."""
    from ..operators.layout import recurring_lines as op

    return op(_lines(spark, sf), 0.005).select(F.md5("line").alias("line"), "pages")


# -- SQL ------------------------------------------------------------------------------------------------------------------
_S = r"[ \t\n\x0B\f\r]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _norm(c: str) -> str:
    out = f"coalesce({c}, '')"
    for a, b in X.NFC.items():
        out = f"replace({out}, {q(a)}, {q(b)})"
    out = f"regexp_replace({out}, '[{X.DROPPED}]', '', 'g')"
    out = f"translate({out}, {q(X.QUOTES_FROM)}, {q(X.QUOTES_TO)})"
    for a, b in X.CARRIERS.items():
        out = f"replace({out}, {q(a)}, {q(b)})"
    # no lookbehind: leading sihari moves where nothing or another character stands before it
    out = f"regexp_replace({out}, '(^|[^{X.CONSONANT}{X.VOWEL_SIGNS}{X.NUKTA}])ਿ([{X.CONSONANT}]{X.NUKTA}?)', '\\1\\2ਿ', 'g')"
    for k in X.COMBINING.replace("ਾ-੍", "ਾਿੀੁੂੇੈੋੌ੍"):
        out = f"regexp_replace({out}, '{k}{k}+', '{k}', 'g')"
    return f"trim(regexp_replace({out}, '{_S}+', ' ', 'g'))"


def _words(c: str) -> str:
    edge = X._class(X.PUNCTUATION).replace("'", "''")
    return f"list_filter(list_transform(string_split({_norm(c)}, ' '), lambda w: regexp_replace(w, '^{edge}+|{edge}+$', '', 'g')), lambda w: w <> '')"


def _hints() -> str:
    d = X.DIGITS

    def num(x: str) -> str:
        return f"try_cast(nullif(regexp_replace(translate({x}, '੦੧੨੩੪੫੬੭੮੯', '0123456789'), '[^0-9]', '', 'g'), '') AS INT)"

    span = rf"{X.PAGES_WORD}\s*([{d}]+)\s*(?:[-–—]\s*([{d}]+))?"
    return f"""h AS (SELECT page, para_no, text, {num(f"regexp_extract(text, '{span}', 1)")} AS lo, {num(f"regexp_extract(text, '{span}', 2)")} AS hi,
        {num(f"regexp_extract(text, '\\(\\s*([{d}]+)\\s*\\)', 1)")} AS bp, {num(f"regexp_extract(text, '([{d}]+)\\s*$', 1)")} AS tail,
        regexp_replace(string_split(text, '(')[1], '^[ :–-]+|[ :–-]+$', '', 'g') AS head FROM t)
        SELECT page, para_no, lo AS ang_from, CASE WHEN coalesce(hi, lo) < lo THEN lo ELSE coalesce(hi, lo) END AS ang_to, coalesce(bp, CASE WHEN lo IS NULL THEN tail END) AS book_page,
        CASE WHEN head <> '' AND NOT regexp_matches(head, '{X.PAGE_NUMBER}') THEN head END AS section FROM h"""


def _grams(c: str) -> str:
    w = f"list_filter(regexp_split_to_array(lower({c}), '\\s+'), lambda x: x <> '')"
    return f"coalesce(list_max(map_values(list_histogram(list_transform(range(1, len({w}) - 4), lambda i: array_to_string(({w})[i:i+5], ' '))))) >= 3, false)"


def queries() -> dict:
    own = (normalise_text, script_of, word_split, footnote_markers, slugs, sentence_split, stamps, header_hints, strip_html_blocks, split_blocks, translation_check, repeated_windows, word_support, book_vocab, oov_rate, recurring_lines)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    samples = "s AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {q(t)})" for i, t in enumerate(SAMPLES)) + ") v(n, text))"
    many = ", ".join(_SIMULATED)
    gram = f"""w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(next), '\\s+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT conv_id, turn, array_to_string(w[i:i+5], ' ') AS gram FROM (SELECT conv_id, turn, w, unnest(range(1, greatest(len(w) - 4, 1))) AS i FROM w) WHERE len(w) >= 6),
        rep AS (SELECT DISTINCT conv_id, turn FROM (SELECT conv_id, turn, gram FROM g GROUP BY ALL HAVING count(*) >= 3))"""
    fault = """CASE WHEN regexp_replace(coalesce(next, ''), '^\\s+|\\s+$', '', 'g') = '' THEN 'empty' WHEN regexp_matches(next, '[਀-੿]') THEN 'source script' WHEN NOT regexp_matches(next, '[A-Za-z]') THEN 'no latin'
        WHEN length(next) > 4 * length(text) + 40 THEN 'too long' WHEN rep.conv_id IS NOT NULL THEN 'repeats' END"""
    return {
        "normalise_text": f"WITH {SQL}, {samples}, r AS (SELECT page * 100000 + para_no AS n, '“' || text || '​ `' AS text FROM paras UNION ALL SELECT -1 - n, text FROM s) SELECT n::BIGINT AS n, {_norm('text')} AS norm FROM r",
        "script_of": f"""WITH {SQL}, {samples}, r AS (SELECT text FROM paras UNION ALL SELECT text FROM s), f AS (SELECT regexp_matches(text, '[਀-੿]') AS g, regexp_matches(text, '[ऀ-ॿ]') AS d, regexp_matches(text, '[A-Za-z]') AS l FROM r)
            SELECT CASE g::INT + d::INT + l::INT WHEN 0 THEN 'none' WHEN 1 THEN CASE WHEN g THEN 'gurmukhi' WHEN d THEN 'devanagari' ELSE 'latin' END ELSE 'mixed' END AS script, count(*) AS n FROM f GROUP BY ALL""",
        "word_split": f"WITH {SQL}, w AS (SELECT page, para_no, {_words('text')} AS w FROM paras) SELECT page, para_no, len(w) AS n, array_to_string(w, '|') AS words FROM w",
        "footnote_markers": f"""WITH {SQL}, w AS (SELECT DISTINCT unnest({_words('text')}) || (para_no % 130)::VARCHAR AS word FROM paras),
            m AS (SELECT word, regexp_extract(word, '{X.FOOTNOTE_MARK}', 1) AS h, regexp_extract(word, '{X.FOOTNOTE_MARK}', 2) AS t FROM w)
            SELECT word, CASE WHEN t <> '' AND regexp_matches(h, '[A-Za-z਀-੿]') THEN h ELSE word END AS bare, CASE WHEN t <> '' AND regexp_matches(h, '[A-Za-z਀-੿]') THEN t END AS marker FROM m""",
        "slugs": f"WITH {SQL} SELECT page, para_no, regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM paras",
        "sentence_split": f"""WITH t AS (SELECT doc_id, list_filter(string_split(regexp_replace(trim(regexp_replace(text, '{_S}+', ' ', 'g')), '([।॥.?!])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS s FROM documents)
            SELECT doc_id, len(s) AS n, s[1] AS first, s[-1] AS last FROM t""",
        "stamps": f"""WITH {SQL}, t AS (SELECT page, para_no, CASE para_no % 5 WHEN 0 THEN 'Page ' || para_no || ' of 530' WHEN 1 THEN 'www.site.example' WHEN 2 THEN '- x - ! page 8 of 530' ELSE text END AS text FROM paras)
            SELECT page, para_no, regexp_matches(text, '{X.STAMP}') OR regexp_matches(text, '{X.STAMP_WORD}') OR (length(text) < 40 AND regexp_matches(text, '{X.STAMP_ANY}')) AS stamp FROM t""",
        "header_hints": f"""WITH {SQL}, t AS (SELECT page, para_no, CASE para_no % 4 WHEN 0 THEN text || ' (' || page || ') ਪੰਨਾ ' || para_no || '-' || (para_no + page % 3 - 1) WHEN 1 THEN text || ' ' || page WHEN 2 THEN 'ਪੰਨਾ ੧੨' ELSE '' END AS text FROM paras), {_hints()}""",
        "strip_html_blocks": """WITH b AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<p(?:\\s[^>]*)?>.*?</p>')) AS block FROM pages)
            SELECT page_id, count(*) AS blocks, sum(length(replace(replace(replace(regexp_replace(regexp_replace(block, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')))::BIGINT AS chars FROM b GROUP BY page_id""",
        "split_blocks": """WITH l AS (SELECT doc_id, (doc_id % 50)::INT AS y0, list_filter(string_split(text, chr(10)), lambda s: trim(s) <> '') AS ls FROM documents),
            e AS (SELECT doc_id, y0, len(ls) AS k, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM l)
            SELECT doc_id, n, (y0 + ((1000 - y0) * (n - 1)) // k)::INT AS y0, (y0 + ((1000 - y0) * n) // k)::INT AS y1, md5(trim(line)) AS line FROM e""",
        "translation_check": f"WITH p AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations), {gram} SELECT p.conv_id, p.turn, {fault} AS fault FROM p LEFT JOIN rep ON rep.conv_id = p.conv_id AND rep.turn = p.turn",
        "repeated_windows": """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents),
            g AS (SELECT doc_id, array_to_string(w[i:i+5], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1))) AS i FROM w) WHERE len(w) >= 6),
            r AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, gram FROM g GROUP BY ALL HAVING count(*) >= 3)) SELECT doc_id, r.doc_id IS NOT NULL AS repeats FROM documents LEFT JOIN r USING (doc_id)""",
        "word_support": f"WITH {SQL} SELECT word, count(*) AS n FROM (SELECT unnest({_words('text')}) AS word FROM paras) GROUP BY word HAVING count(*) >= 3",
        "book_vocab": f"""WITH {SQL}, r AS (SELECT page, para_no, unnest([{many}]) AS text, generate_subscripts([1, 2, 3], 1) AS k FROM paras),
            w AS (SELECT DISTINCT page, para_no, k, unnest({_words('text')}) AS word FROM r), a AS (SELECT page, para_no, word FROM w GROUP BY ALL HAVING count(*) >= 2)
            SELECT word, count(*) AS n FROM a GROUP BY word HAVING count(*) >= 3""",
        "oov_rate": f"""WITH {SQL}, d AS (SELECT unnest({_words('text')}) AS word FROM paras), k AS (SELECT word FROM d GROUP BY word HAVING count(*) >= 20 UNION SELECT unnest({_words('text')}) FROM lines),
            w AS (SELECT page, para_no, unnest({_words('text')}) AS word FROM paras), c AS (SELECT page, para_no, w.word, k.word IS NOT NULL OR regexp_matches(w.word, '{L.NUMERIC}') AS known FROM w LEFT JOIN k ON k.word = w.word WHERE length(w.word) >= 2),
            n AS (SELECT page, para_no, count(*) AS n_words, count(*) FILTER (NOT known) AS n_unknown FROM c GROUP BY ALL)
            SELECT p.page, p.para_no, coalesce(n_words, 0) AS n_words, coalesce(n_unknown, 0) AS n_unknown FROM paras p LEFT JOIN n ON n.page = p.page AND n.para_no = p.para_no""",
        "recurring_lines": f"WITH {SQL}, t AS (SELECT count(DISTINCT page) AS n FROM paras) SELECT md5(trim(text)) AS line, count(DISTINCT page) AS pages FROM paras GROUP BY trim(text) HAVING count(DISTINCT page) >= (SELECT greatest(2, (n * 5) // 1000) FROM t)",
    }
