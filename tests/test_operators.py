"""Operators on small hand-made inputs: what each one promises, and the traps it must not fall into."""

import json
import os
import random
import sqlite3
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmark.functions import text as X
from leafmark.functions.legacy_font import to_unicode
from leafmark.operators import alignment, citations, evaluate, fusion, layout, ledger, lexicon, listing, matching, merging, pdf_lines, repair, sampling, translation, units, vectors
from leafmark.operators import truth as truth_
from leafmark.plans import pipeline
from leafmark.sinks import tables as sinks
from leafmark.sources import dictionary, engines, filenames, tables
from leafmark.streaming import ledger as streams


def one(spark, column, **values):
    names, kinds = list(values), ", ".join(f"{k} {'string' if isinstance(v, str | None) else 'int'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values[n] for n in names)], kinds).select(column.alias("x")).first().x


# -- text -----------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("typed, want", [("ਅਾਪ", "ਆਪ"), ("ਿਕ", "ਕਿ"), ("ਸਤਿਿ", "ਸਤਿ"), (" a ​ b ", "a b"), ("‘x’ “y”", "'x' \"y\""), ("ਸ਼", "ਸ਼"), (None, ""), ("ੲਿਕ", "ਇਕ")])
def test_normalise(spark, typed, want):
    got = one(spark, X.normalise(F.col("t")), t=typed)
    assert got == want and one(spark, X.normalise(F.col("t")), t=got) == got


def test_graphemes_and_scripts(spark):
    assert one(spark, X.graphemes(F.col("t")), t="ਸਤਿ a") == ["ਸ", "ਤਿ", " ", "a"]
    assert [one(spark, X.script_of(F.col("t")), t=t) for t in ("ਸਤਿ", "abc", "देव", "ਸ a", "12")] == ["gurmukhi", "latin", "devanagari", "mixed", "none"]


def test_words_and_markers(spark):
    assert one(spark, X.words(F.col("t")), t="(one) “two”, three... ॥") == ["one", "two", "three"]
    got = one(spark, X.footnote_marker(F.col("t")), t="ਸ਼ਬਦ੧")
    assert (got.word, got.marker) == ("ਸ਼ਬਦ", "੧")
    assert one(spark, X.footnote_marker(F.col("t")), t="1999").marker is None


@pytest.mark.parametrize("typed, ang, rest", [("x (SGGS p. 920)", 920, "x"), ("x [Pg. 289] y", 289, "x   y"), ("some words (661)", 661, "some words ( )"), ("well up.921", 921, "well up."), ("a 1349-1350 Bh. Kabir", 1349, None), ("page 1", None, "page 1"), ("x 1999", None, "x 1999")])
def test_found_ang(spark, typed, ang, rest):
    got = one(spark, X.found_ang(F.col("t")), t=typed)
    assert got.ang == ang and (rest is None or " ".join(got.rest.split()) == " ".join(rest.split()))


def test_quotes(spark):
    assert one(spark, X.clean_quote(F.col("t")), t="12. O mind ||1|| Pause || turn back. 921") == "O mind turn back"
    assert one(spark, X.looks_quoted(F.col("t")), t="plain 45") is False and one(spark, X.looks_quoted(F.col("t")), t="verse 921") is True
    assert one(spark, X.wholly(F.col("t")), t='"All of it." 921') is True


def test_header_hints(spark):
    got = one(spark, X.header_hints(F.col("t")), t="Section ( ੧੮੩ ) ਗ੍ਰੰਥ ਪੰਨਾ 12-10")
    assert (got.ang_from, got.ang_to, got.book_page, got.section) == (12, 12, 183, "Section")
    assert one(spark, X.header_hints(F.col("t")), t="") == (None, None, None, None)


def test_translation_faults(spark):
    fault = X.translation_fault(F.col("s"), F.col("t"))
    cases = [("a", "", "empty"), ("a", "ਸਤਿ x", "source script"), ("a", "12", "no latin"), ("a", "b" * 50, "too long"), ("x" * 100, "one two three four five six " * 3, "repeats"), ("x" * 100, "a fair answer", None)]
    assert [one(spark, fault, s=s, t=t) for s, t, _ in cases] == [c[2] for c in cases]
    assert one(spark, X.without_thinking(F.col("t")), t="<think>a\nb</think> yes") == "yes"


LEGACY = [("hUM", "ਹੂੰ"), ("lweIAW", "ਲਾਈਆਂ"), ("ibKu kw kIVw ibKu isau lwgw ibs†w mwih smweI ]", "ਬਿਖੁ ਕਾ ਕੀੜਾ ਬਿਖੁ ਸਿਉ ਲਾਗਾ ਬਿਸ੍ਟਾ ਮਾਹਿ ਸਮਾਈ ॥"), ("ਯੂਨੀਕੋਡ", "ਯੂਨੀਕੋਡ"), ("", ""), (None, None)]


@pytest.mark.parametrize("typed, want", LEGACY)
def test_legacy_font(spark, typed, want):
    assert one(spark, to_unicode(F.col("t")), t=typed) == want


@pytest.mark.parametrize("name, want", [("2014010101014-Some_Title-Part-2_edit", (14, 2, "Some Title", "some-title")), ("Lekh_7_Divine-Wil", (7, None, "Divine Will", "divine-wil")), ("Hukum Part", (None, None, "Hukum Part", "hukum-part")), ("2014010101Hukum_SS_final_2", (None, None, "Hukam", "hukam")), ("Power of Thoughts 2", (None, None, "Power of Thoughts 2", "power-of-thoughts-2"))])
def test_filenames(spark, name, want):
    got = one(spark, filenames.parsed(F.col("t")), t=name)
    assert (got.essay, got.part, got.title, got.work) == want


def test_rosters(spark):
    files = spark.createDataFrame([("1492003384127-Dhooja-Bhau-Part-2.pdf",), ("Lekh-110-Simran-Part-1-SS-English-_-Punjabi.pdf",), ("Odd 3.pdf",), ("1491995000063-Shabad-Part-6-edit-2-JK-fixed.pdf",)], "file string")
    roster = spark.createDataFrame([("Odd 3.pdf", "odd", "The Odd One", 3, None, "B", True, None), ("bad.pdf", "bad", "Bad", None, None, None, None, "scan too poor")], filenames.ROSTER)
    got = {r.file: (r.essay, r.part, r.title, r.work, r.author) for r in filenames.works(files, roster).collect()}
    assert list(got.values()) == [(127, 2, "Dhooja Bhau", "dhooja-bhau", None), (110, 1, "Simran", "simran", None), (None, 3, "The Odd One", "odd", "B"), (63, 6, "Shabad", "shabad", None)]
    assert filenames.unnamed(files, roster).count() == 3
    rows = filenames.works(files.unionByName(spark.createDataFrame([("bad.pdf",)], "file string")), roster)
    take, held = filenames.taken(rows)
    assert take.count() == 4 and [(r.file, r.why) for r in held.collect()] == [("bad.pdf", "scan too poor")]
    more = spark.createDataFrame([("b.pdf", "w", "T", 2, None, True, None, "en", "cc"), ("a.pdf", "w", "U", None, "X", False, None, "pa", None), ("c.pdf", "w", "T", 1, None, True, None, "en", None)], "file string, work string, title string, part int, author string, original boolean, quote_policy string, language string, licence string")
    r = filenames.rolled_up(more, "Z").first()
    assert (r.title, r.author, r.original, r.quote_policy, r.parts, r.names, r.files, r.language) == ("T", "X", False, "summarise", [1, 2], ["a.pdf", "b.pdf", "c.pdf"], 3, "pa")


# -- alignment ------------------------------------------------------------------------------------------------------------
def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_edit_scripts_turn_one_into_the_other(a, b):
    ops = alignment.edit_ops(list(a), list(b))
    assert len(ops) == distance(a, b)
    out, at = [], 0
    for tag, i, j in ops:
        out += a[at:i]
        at = i + (tag != "insert")
        out += b[j : j + 1] if tag != "delete" else []
    assert "".join(out) + a[at:] == b
    pos = alignment.boundaries(list(a), list(b))
    assert pos[-1] == len(b) and pos == sorted(pos)
    best = max((len(s) for s in _subsequences(a) if _inside(s, b)), default=0)
    assert alignment.lcs(list(a), list(b)) == best


@settings(max_examples=100, deadline=None)
@given(st.text("ab", max_size=14), st.text("ab", max_size=14))
def test_halved_edit_scripts_cost_no_more(a, b):
    old, alignment.CELLS = alignment.CELLS, 12
    try:
        ops = alignment.edit_ops(list(a), list(b))
    finally:
        alignment.CELLS = old
    assert len(ops) == distance(a, b)
    assert [i for _, i, _ in ops] == sorted(i for _, i, _ in ops)


def _subsequences(a):
    out = {""}
    for x in a:
        out |= {s + x for s in out}
    return out


def _inside(s, b):
    it = iter(b)
    return all(x in it for x in s)


def test_levenshtein_of_items(spark):
    rows = spark.createDataFrame([(list("kitten"), list("sitting")), ([], ["a"]), (["ਤਿ", "ਸ"], ["ਤ", "ਸ"])], "a array<string>, b array<string>")
    assert [r.x for r in rows.select(X.levenshtein_items(F.col("a"), F.col("b")).alias("x")).collect()] == [3, 1, 1]


def test_vote():
    read = lambda t, w=1.0, c=None: {"items": list(t), "weight": w, "conf": c}
    assert alignment.vote([read("cat"), read("cat"), read("cat")])[:2] == ("cat", 1.0)
    assert alignment.vote([read("cot"), read("cat"), read("cat")])[:2] == ("cat", round(2 / 3, 3))
    assert alignment.vote([read("ct"), read("cat"), read("cat")])[0] == "cat"
    assert alignment.vote([read("cat"), read("cut")])[0] == "cat"
    assert alignment.vote([read("ct"), read("cat"), read("cart")])[0] == "ct" and alignment.vote([read("cat"), read("ca"), read("ca")])[0] == "ca"
    assert alignment.vote([read("abc"), read("abc xx", 0.4), read("  ")]) == ("abc", 1.0, None, 2)
    assert alignment.vote([read("cat", c=0.5)])[:3] == ("cat", None, 0.5) and alignment.vote([]) == ("", None, None, 0)


def test_segmented_blocks(spark):
    rows = spark.createDataFrame([(list("onetwo three"), [list("one"), list("two"), list("three")])], "b array<string>, ls array<array<string>>")
    assert rows.select(alignment.segmented("b", "ls").alias("x")).first().x == ["one", "two", "three"]


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=7, max_size=40), st.text("abc", min_size=5, max_size=9))
def test_skipped_windows_are_no_better(q, c):
    q, c = list(q), list(c)
    best, span = 2 * alignment.lcs(q, c) / (len(q) + len(c)), None
    if len(q) >= len(c) + 2:
        for end in range(1, len(q) + len(c)):
            lo, hi = max(0, end - len(c)), min(len(q), end)
            if (s := 2 * alignment.lcs(q[lo:hi], c) / (hi - lo + len(c))) > best:
                best, span = s, (lo, hi)
    assert alignment.similarity(q, c) == (best, span)


def test_partial_similarity():
    assert alignment.similarity(list("abc"), list("abc")) == (1.0, None)
    s, span = alignment.similarity(list("xxxhelloyyy"), list("hello"))
    assert s == 1.0 and span == (3, 8)


def test_candidates_agree_with_and_without_a_broadcast(spark):
    rng = random.Random(8)
    text = lambda: "".join(rng.choice("abcde ") for _ in range(30))
    q = spark.createDataFrame([(i, text()) for i in range(20)], "qid long, text string").withColumn("key", matching.match_key(F.col("text")))
    c = spark.createDataFrame([(i, text()) for i in range(50)], "line_id long, text string").withColumn("key", matching.match_key(F.col("text")))
    one, two = ({tuple(r) for r in matching.candidates(q, c, 7, bound).select("qid", "line_id", "hits").collect()} for bound in (0, 10**6))
    assert one == two and one


def test_match_all(spark):
    corpus = [(1, 10, "naam ke dhare sagle jant"), (2, 10, "naam ke dhare khand brahmand"), (3, 11, "naam ke dhare sagle jaat"), (4, 12, "completely different words here")]
    c = spark.createDataFrame(corpus, "line_id long, ang long, text string").withColumn("key", matching.match_key(F.col("text")))
    q = spark.createDataFrame([(1, "xx naam ke dhare khand brahmand yy", 10), (2, "nothing like that at all", None), (3, "short", None)], "qid long, text string, ang_from long").withColumn("ang_to", F.col("ang_from")).withColumn("key", matching.match_key(F.col("text")))
    got = matching.match_all(q, c).collect()
    assert [(r.qid, r.line_id, r.method, r.score) for r in got] == [(1, 2, "ang-window", 1.0)]


def test_key_spans_lead_back_to_the_line(spark):
    line = "ਸਤਿ, ਨਾਮੁ ॥੧॥ ਰਹਾਉ ॥ end. ॥"
    got = one(spark, matching.key_spans(F.col("t")), t=line)
    norm = one(spark, X.normalise(F.col("t")), t=line)
    assert [x.g for x in got] == one(spark, matching.match_key(F.col("t")), t=line)
    assert [norm[x.start : x.end] for x in got] == ["ਸ", "ਤਿ", "ਨਾ", "ਮੁ", "e", "n", "d"]
    match = F.expr("array(named_struct('start', 0, 'end', 4, 'text', 'ਸਤਿ ਨਾਮੁ ॥'))")
    assert one(spark, matching.replaced(F.col("t"), match), t="xx ॥੧॥ ਸਤਿ ਨਾਮ ॥ 12").endswith("12")
    assert one(spark, matching.replaced(F.col("t"), F.expr("array(named_struct('start', 2, 'end', 6, 'text', 'NEW॥'))")), t="ab cdef ॥ gh") == "ab NEW॥ gh"


def test_best_reading(spark):
    rows = [(1, 0, 0, 0.9, 0, 5, 20, False), (1, 1, 0, 0.8, 0, 8, 10, False), (2, 0, 0, 0.9, 0, 3, 20, True), (2, 1, 1, 0.5, 0, 3, 20, True), (2, 1, 1, 0.4, 4, 9, 20, True)]
    got = matching.best_reading(spark.createDataFrame(rows, "line int, reading int, source int, score double, start int, end int, key_size int, quotable boolean"), ["line"])
    assert sorted((r.line, r.reading, r.source) for r in got.collect()) == [(1, 1, 0), (2, 0, 0)]


def test_truth_readings(spark):
    words = [(0, 0, 40, 30, "left"), (100, 0, 140, 30, "right"), (150, 0, 190, 30, "side")]
    lines = [(1, 1, 0, 0, 200, 30, "left right side", None, words), (1, 2, 0, 40, 200, 70, "tail", 1, None), (1, 3, 0, 100, 200, 130, "alone", None, None)]
    kind = "page int, n int, x0 int, y0 int, x1 int, y1 int, text string, merged_into int, words array<struct<x0:int,y0:int,x1:int,y1:int,text:string>>"
    truth = [(1, "a", 95, 0, 200, 30, "right side"), (1, "b", 0, 40, 200, 70, "left right side tail"), (1, "c", 0, 300, 50, 330, "gone"), (2, "d", 0, 0, 9, 9, "unread page")]
    got = truth_.readings(spark.createDataFrame(truth, "page int, id string, x0 int, y0 int, x1 int, y1 int, text string"), spark.createDataFrame(lines, kind), ["page"])
    assert {r.id: r.hyp for r in got.collect()} == {"a": "right side", "b": "left right side tail", "c": ""}
    assert one(spark, truth_.window_of(F.col("r"), F.col("h")), r="the third line", h="the first line the second line the thirb line the last line") == "the thirb line"
    assert one(spark, truth_.window_of(F.col("r"), F.col("h")), r="abcd", h="abcdefg") == "abcdefg"


def test_pages_to_read(spark):
    make = lambda rows: spark.createDataFrame(rows, "book string, page int")
    pages = make([("a", k) for k in range(1, 7)] + [("b", 1)])
    got = listing.selected_pages(pages, make([("a", k) for k in range(2, 7)]), [make([("a", 3), ("a", 4), ("a", 6)])], make([("a", 4)]), 5)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 3), ("a", 6)]
    assert listing.selected_pages(pages, most=1).count() == 2


def test_stamps_and_stanzas(spark):
    rows = spark.createDataFrame([(1, "x", "Page 8 of 530"), (1, "y", "। 2੩06"), (2, "x", "verse")], "n int, engine string, text string")
    assert [r.n for r in fusion.stamped(rows, ["n"]).collect()] == [1]
    assert one(spark, X.is_stanza_end(F.col("t")), t="ਲਿਖਿਆ ਨਾਲਿ ॥੧॥") is True and one(spark, X.is_stanza_end(F.col("t")), t="॥ ਰਹਾਉ ॥") is False


# -- citations ------------------------------------------------------------------------------------------------------------
def test_resolution_needs_overlap_and_margin(spark):
    lines = [(1, 1, 5, "mercy wisdom patience truth"), (2, 2, 5, "mercy wisdom patience truth"), (3, 3, 5, "lotus ocean silent river mountain"), (4, 4, 5, "wind rain")]
    c = spark.createDataFrame(lines, "line_id long, verse_group long, ang long, text string")
    p = spark.createDataFrame([("w", 1, 1, "mercy and wisdom, patience and truth forever"), ("w", 1, 2, "the lotus ocean silent river mountain sings"), ("w", 1, 3, "wind rain snow hail storm")], "work string, page long, para_no long, text string")
    got = {r.para_no: r.status for r in citations.resolve(p, c).collect()}
    assert got == {1: "ambiguous", 2: "resolved"}


def test_detection_joins_halves(spark):
    rows = [("w", 1, 1, "body", '"whoever remembers the name with devotion shall'), ("w", 2, 1, "body", "find lasting peace within their heart (SGGS p. 92)"), ("w", 2, 2, "body", "plain prose follows here")]
    got = citations.detect(spark.createDataFrame(rows, "work string, page long, para_no long, style string, text string")).collect()
    assert [(r.page, r.opened_page, r.ang) for r in got] == [(2, 1, 92)] and got[0].quote.startswith('"whoever')


# -- units ----------------------------------------------------------------------------------------------------------------
KIND = "work string, part string, page long, para_no long, style string, text string, text_src string, cites array<string>"


def built(spark, rows, target=5, hard=60):
    frame = spark.createDataFrame([("w", p, 1, i, s, t, None, c) for i, (p, s, t, c) in enumerate(rows)], KIND)
    return [(r.text, list(r.cites)) for r in units.build_units(frame, target, hard).orderBy("seq").collect()]


def test_units(spark):
    assert built(spark, [("1", "body", "one two three. four five six.", [])]) == [("one two three. four five six.", [])]
    # a heading goes with what follows, its verse is carried on when it stands alone
    assert built(spark, [("1", "heading", "Title", []), ("1", "quote", "verse", ["7"]), ("2", "body", "prose of another part here.", [])]) == [("prose of another part here.", ["7"])]
    # a quotation belongs to the prose before it, once
    assert built(spark, [("1", "body", "some words of prose here.", []), ("1", "quote", "v", ["7"]), ("1", "quote", "v", ["7"])]) == [("some words of prose here.", ["7"])]
    # the cap is soft: a sentence is never cut
    assert len(built(spark, [("1", "body", "a b c d e f g h i j k l", [])], 3, 5)) == 1


def test_parts_come_by_number(spark):
    rows = [("w", p, 1, 0, "body", f"words of part {p} here.", None, []) for p in ("10", "2", "1", None)]
    got = units.build_units(spark.createDataFrame(rows, KIND), 3, 60).orderBy("seq").collect()
    assert [r.part for r in got] == [None, "1", "2", "10"]


def test_unit_rows_are_dense(spark):
    rows = [(f"w{k % 3}", "1", 1, k, "body", "three words here. " * 3, None, []) for k in range(30)]
    got = units.numbered(units.build_units(spark.createDataFrame(rows, KIND), 6, 20)).orderBy("unit_row").collect()
    assert [r.unit_row for r in got] == list(range(len(got))) and [r.work for r in got] == sorted(r.work for r in got)


def test_kept_spans(spark):
    rows = spark.createDataFrame([("w", 1, i, t) for i, t in enumerate("intro|Begin here|middle|the end|after".split("|"))], "work string, page long, para_no long, text string")
    span = lambda stop: spark.createDataFrame([("w", 1, "Begin", stop)], "work string, k int, start string, stop string")
    assert [r.text for r in units.kept_spans(rows, span("end")).orderBy("para_no").collect()] == ["Begin here", "middle", "the end"]
    with pytest.raises(Exception, match="span without an end"):
        units.kept_spans(rows, span("never")).collect()


def test_split_to_fit():
    assert units.split_to_fit("a b. c d. e f g h i. j", 4) == ["a b. c d.", "e f g h i.", "j"]


# -- repair: each case is a trap ------------------------------------------------------------------------------------------
ENGLISH = {"and", "word", "own", "inner", "not", "the", "company", "mind", "is", "of", "to", "thee", "external", "influence", "influences", "thought", "thoughts", "touch"}


@pytest.mark.parametrize("text, want", [("doing P aath or S imran", "doing Paath or Simran"), ("the Guru’s word is true", "the Guru’s word is true"), ("the Guru ’s word", "the Guru’s word"), ("becomes blotles s and is", "becomes blotless and is"), ("makes bodi s and is", "makes bodi s and is"), ("our thought s and influence s", "our thoughts and influences"), ("shall touch the e not", "shall touch thee not"), ("with the e xternal music", "with the e xternal music"), ("I saw a while", "I saw a while"), ("the wo rld", "the world")])
def test_repair(text, want):
    author = {"paath", "simran", "world", "blotless"}
    assert repair.repaired(text, lambda w: w.lower() in ENGLISH | author, lambda w: w.lower() in ENGLISH)[0] == want


def test_repair_asks_the_author(spark):
    rows = spark.createDataFrame([(1, "S imran"), (2, "Simran"), (3, "Simran"), (4, "Simran"), (5, "P aath")], "n long, text string")
    english = spark.createDataFrame([(w,) for w in ENGLISH], "word string")
    got = {r.n: (r.text, r.joins) for r in repair.repair(rows, english, ["n"]).collect()}
    assert got[1] == ("Simran", 1) and got[5] == ("P aath", 0)


# -- layout ---------------------------------------------------------------------------------------------------------------
def test_zones(spark):
    box = lambda n, y, text, h=40: (1, n, 100, y, 1000, y + h, text, 3300, None, None)
    rows = [box(1, 50, "Running head"), box(2, 500, "Body text of the page"), box(3, 560, "More body text"), box(4, 900, "Page 8 of 530"), box(5, 3200, "12"), box(6, 3000, "1. a note", 20), box(7, 3030, "goes on", 20)]
    frame = spark.createDataFrame(rows, "page long, n long, x0 int, y0 int, x1 int, y1 int, text string, page_h int, rule_y int, zone string").withColumn("stamps", F.array().cast("array<struct<x0:int,y0:int,x1:int,y1:int>>"))
    assert {r.n: r.zone for r in layout.zones(frame, ["page"]).collect()} == {1: "header", 2: "body", 3: "body", 4: "stamp", 5: "pageno", 6: "footnote", 7: "footnote"}


def test_pdf_lines_and_paragraphs(spark):
    run = lambda x, y, t, italic=False, width=None: (1, float(x), float(y), 10.0, italic, t, width, None)
    rows = [run(50, 700, "Hel", width=15.0), run(65, 701, "lo", width=10.0), run(80, 700, "there", width=25.0), run(50, 688, "second self-"), run(50, 676, "willed line"), run(62, 664, "indented new paragraph"), run(50, 652, "quoted words", True)]
    lines = pdf_lines.lines_of(spark.createDataFrame(rows, "page long, x double, y double, size double, italic boolean, text string, width double, space double"), ["page"])
    assert [r.text for r in lines.orderBy("n").collect()] == ["Hello there", "second self-", "willed line", "indented new paragraph", "quoted words"]
    got = pdf_lines.paragraphs_of(lines.withColumn("margin", F.lit(50.0)), ["page"], 10.0).orderBy("para").collect()
    assert [(r.style, r.text) for r in got] == [("body", "Hello there second self-willed line"), ("body", "indented new paragraph"), ("quote", "quoted words")]


def test_furniture(spark):
    rows = [("b", p, n, t) for p in range(1, 11) for n, t in enumerate([f"NATURAL MEDITATION {p + 4}", "first line " + "z" * p, "www.site", "body " + "x" * p, "last " + "y" * p], 1)]
    got = pdf_lines.furniture(spark.createDataFrame(rows, "book string, page long, n long, text string"))
    assert "NATURAL MEDITATION" in {r.head for r in got["heads"].collect()}
    assert got["offset"].first().offset == -4 and {r.text for r in got["stamps"].collect()} == {"www.site"}


def test_merging_steps(spark):
    tidy = lambda t, *c: one(spark, merging.tidy_seams(F.col("t"), F.array(*map(F.lit, c))), t=t)
    assert tidy("।, so the the river runs", "the river runs") == "so the river runs"
    assert tidy("breathe the river runs", "the river runs") == "breathe the river runs" and tidy("the the sea", "the sea") == "the sea"
    assert tidy("a  b ॥ ॥ ।", "x") == "a b ॥" and tidy("the sea", "the sea") == "the sea"
    spans = F.expr("array(named_struct('start', 4, 'end', 7, 'new', 'XX'), named_struct('start', 6, 'end', 9, 'new', 'Y'))")
    assert one(spark, merging.spliced(F.col("t"), spans), t="abc def ghi") == "abc XXYhi"
    streams_ = spark.createDataFrame([(1, 0, 5, [3, 4])], "page long, run long, first int, sizes array<int>")
    found = spark.createDataFrame([(1, 0, 77, 1, 6)], "page long, run long, line_id long, start int, end int")
    assert sorted((r.n, r["from"], r.to, r.anchor) for r in merging.stream_parts(found, streams_, ["page"]).collect()) == [(5, 1, 3, True), (6, 0, 3, False)]


# -- fusion, ledger, evaluation -------------------------------------------------------------------------------------------
def test_routing(spark):
    case = lambda **k: one(spark, fusion.arbiter_reason(*[F.lit(k.get(c)).cast(t) for c, t in (("kind", "string"), ("agreement", "double"), ("oov", "double"), ("n_words", "int"), ("conf", "double"))], lang="pa"), t="x")
    assert case(kind="gurbani", agreement=0.1) is None and case(kind="gurbani-unmatched") == "unmatched-bold"
    assert case(kind="c", agreement=0.8) == "low-agreement" and case(kind="c", oov=0.5, n_words=6) == "oov"
    assert case(kind="c", oov=0.5, n_words=3) is None and case(kind="c", conf=0.4) == "low-conf" and case(kind="c") is None


def test_budget(spark, tmp_path):
    b = ledger.Budget(spark, f"{tmp_path}/ledger", 0.01)
    assert b.spent_this_month() == 0 and b.allows(0.01)
    for _ in range(6):
        b.charge("vision", "book", 1, 0.0015)
    assert b.spent_this_month() == 0.009 and not b.allows(0.0015)
    todo = spark.createDataFrame([("u", "x" * 100)], "unit_id string, src string")
    with pytest.raises(RuntimeError, match="over budget"):
        translation.gated(todo, b, 0.001)


def test_translation_scores():
    assert evaluate.chrf(["the cat"], ["the cat"]) == pytest.approx(100) and evaluate.bleu(["the cat sat on mats"], ["the cat sat on mats"]) == pytest.approx(100)
    close, far = evaluate.chrf(["the cat sat"], ["the cat sits"]), evaluate.chrf(["dogs ran"], ["the cat sits"])
    assert 100 > close > far >= 0 and evaluate.bleu([""], ["x"]) == 0


def test_corrections(spark):
    known = spark.createDataFrame([("hello",), ("world",), ("cold",), ("bold",)], "word string")
    asked = spark.createDataFrame([("hellc",), ("xold",), ("zzzzz",)], "word string")
    got = {r.word: (r.best, r.verdict) for r in lexicon.corrections(asked, known, {"c>o": 0.3, "x>c": 0.3, "x>b": 0.3}).collect()}
    assert got == {"hellc": ("hello", "corrected"), "xold": ("bold", "ambiguous")}


def test_requests(spark):
    assert translation.batches(["a" * 5, "b" * 5, "c" * 20, "d"], 2, 12, len) == [["a" * 5, "b" * 5], ["c" * 20], ["d"]]
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("HTTP 503")
        return "ok"

    assert translation.retried(flaky, sleep=calls.append) == "ok"
    with pytest.raises(ValueError):
        translation.retried(lambda: int("x"), sleep=calls.append)
    todo = spark.createDataFrame([("a", "text"), ("b", "longer text")], "unit_id string, src string")
    assert {r.unit_id: r.en for r in translation.translated(todo, translation.EchoEngine, "pa").collect()} == {"a": "[pa] text", "b": "[pa] longer text"}
    answer = F.from_json(F.lit('{"id": "1", "pairs": [{"w": "a", "en": "x"}]}'), "id string, en string, pairs array<struct<w:string,en:string>>")
    sent = lambda w: F.from_json(F.lit(json.dumps({"id": "1", "pairs": [{"w": w, "src": "s"}]})), "id string, src string, pairs array<struct<w:string,src:string>>")
    assert one(spark, translation.answer_fault(sent("a"), answer), t="") is None and one(spark, translation.answer_fault(sent("b"), answer), t="") == "headwords changed"
    assert one(spark, translation.parsed_array(F.col("t"), "struct<id:string>"), t='```json\n[{"id": "7"}]\n```')[0].id == "7"


# -- vectors, samples, sinks ----------------------------------------------------------------------------------------------
def test_vectors(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) * (10 if k < 4 else 1) for k in range(12)]) for i in range(60)]
    reduced, mean, parts, variance = vectors.pca(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 4)
    assert variance == sorted(variance, reverse=True) and len(parts) == 4 and len(mean) == 12
    coded = reduced.select(F.col("vec_id").alias("unit_row"), vectors.quantised(F.col("reduced")).alias("q"), "reduced").select("unit_row", "q.codes", "q.scale", "reduced")
    for r in coded.collect():
        assert max(map(abs, r.codes)) == 127
        assert all(abs(c * r.scale - x) <= r.scale / 2 + 1e-6 for c, x in zip(r.codes, r.reduced, strict=True))
    top = vectors.top_k(coded, coded.where("unit_row = 7").first().reduced, 3).collect()
    assert top[0].unit_row == 7
    out = sinks.export_vectors(coded, mean, parts, str(tmp_path / "index"))
    assert out["files"] == {"units.i8": 240, "units.scale.f32": 240, "units.mask.u8": 60, "pca.components.f32": 192, "pca.mean.f32": 48}
    raw = (tmp_path / "index" / "units.i8").read_bytes()
    assert list(struct.unpack("<4b", raw[:4])) == coded.where("unit_row = 0").first().codes


def test_sqlite_export(spark, tmp_path):
    path = str(tmp_path / "db.sqlite")
    frames = {"units": spark.createDataFrame([(0, "w:1:1:1", "w", 1, 1, 1, None, "text", None)], "unit_row long, unit_id string, work_id string, part int, page int, para_no int, marker string, text string, text_src string"), "works": spark.createDataFrame([("w", "T", None, "A", "root", True, "verbatim", [1, 2], 1, 1, "en", None)], "work_id string, title string, title_en string, author string, folder string, original boolean, quote_policy string, parts array<int>, files int, units int, language string, licence string")}
    for _ in range(2):  # rebuilt whole
        sinks.export_sqlite(frames, path)
    con = sqlite3.connect(path)
    assert con.execute("SELECT original, parts FROM works").fetchall() == [(1, "[1, 2]")] and con.execute("SELECT count(*) FROM units").fetchone() == (1,)
    assert [r[1] for r in con.execute("PRAGMA table_info(citations)")] == sinks.columns_of("citations")


def test_works_are_replaced_alone(spark, tmp_path):
    path = f"{tmp_path}/works"
    frame = lambda rows: spark.createDataFrame(rows, "work string, text string")
    sinks.write_works(frame([("a", "old"), ("b", "old")]), path)
    sinks.write_works(frame([("b", "new")]), path)
    assert {(r.work, r.text) for r in spark.read.parquet(path).collect()} == {("a", "old"), ("b", "new")}
    assert sinks.db_name("writings-en") == "writings.sqlite" and sinks.units_name("pa") == "units-pa.jsonl"


def test_samples(spark):
    rows = spark.createDataFrame([(i, i % 3, i * 7 % 50) for i in range(60)], "id long, kind int, n int")
    got = sampling.quota_sample(rows.withColumn("kind", F.col("kind").cast("string")), "kind", "id", {"0": 5, "1": 2})
    assert {r.kind: r["count"] for r in got.groupBy("kind").count().collect()} == {"0": 5, "1": 2}
    thirds = sampling.thirds(rows, "n", "id").groupBy("third").agg(F.count("*").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi")).orderBy("third").collect()
    assert [r.c for r in thirds] == [20, 20, 20] and thirds[0].hi <= thirds[1].lo and thirds[1].hi <= thirds[2].lo
    assert sampling.even_indices(10, 6) == [0, 1, 3, 5, 6, 8] and sampling.even_indices(3, 6) == [0, 1, 2]


# -- sources --------------------------------------------------------------------------------------------------------------
def test_jsonl(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"_meta": {"work": "w", "lang": "en"}}\n\n{"id": "1", "text": "a"}\nnot json\n{"id": "2", "text": "b"}\n')
    assert [(r.id, r.text) for r in tables.read_jsonl(spark, str(path), "id string, text string").collect()] == [("1", "a"), ("2", "b")]
    assert tables.read_jsonl(spark, str(tmp_path / "none.jsonl"), "id string, text string").collect() == []
    for name in ("citations", "units-en", "x.en"):
        (tmp_path / f"{name}.jsonl").write_text('{"_meta": {"work": "no"}}\n{"id": "9", "text": "z"}\n')
    heads, records = tables.read_works(spark, str(tmp_path), "work string, lang string", "id string, text string")
    assert [r.work for r in heads.collect()] == ["w"] and sorted(r.id for r in records.where("id is not null").collect()) == ["1", "2"]
    assert tables.read_works(spark, str(tmp_path / "nowhere"), "work string", "id string")[1].count() == 0
    assert [(r.work, r.lang) for r in tables.read_meta(spark, str(path), "work string, lang string").collect()] == [("w", "en")]


def test_manifest(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps({"author": "A", "licence": "public-domain", "works": [{"file": "One.pdf"}, {"file": "Two.pdf", "licence": "copyright", "author": "B", "language": "pa"}]}))
    got = tables.sources(tables.read_manifest(spark, str(path))).orderBy("n").collect()
    assert [(r.work, r.author, r.language, r.quote_policy) for r in got] == [("one", "A", "en", "verbatim"), ("two", "B", "pa", "summarise")]
    path.write_text(json.dumps({"author": "A"}))
    with pytest.raises(Exception, match="works must be a list"):
        tables.sources(tables.read_manifest(spark, str(path))).collect()
    assert tables.page_numbers("1-3,7", 10) == [0, 1, 2, 6] and tables.page_numbers(None, 2) == [0, 1] and tables.page_numbers("9-20", 10) == [8, 9]


def test_engines(spark):
    with pytest.raises(ValueError, match="unknown engine"):
        engines.load("nothing")
    pages = spark.createDataFrame([(1, b"x")], "page long, image binary")
    assert engines.recognised(pages, lambda: engines.load("blank"), "pa").count() == 0
    assert one(spark, engines.unmarked(F.col("t")), t="# Head\n**bold** text") == "Head\nbold text"
    src = spark.createDataFrame([("good", "r"), ("bad", "none")], "file string, reader string")
    got, failed = engines.readable(src, {"r": lambda f: spark.range(2).toDF("n")}, spark)
    assert got.count() == 2 and failed[0][0] == "bad"


def test_texts_name_known_translators(spark):
    lines = spark.createDataFrame([(1, "॥੧॥"), (2, "ਸਤਿ ਨਾਮੁ ॥੧॥ ਰਹਾਉ ॥")], "line_id long, text string")
    tr = spark.createDataFrame([(1, "x", " a  b ")], "line_id long, translator string, text string")
    assert {(r.line_id, r.source): r.text for r in dictionary.texts(lines, tr, ["own", "x"]).collect()} == {(1, "own"): "॥੧॥", (2, "own"): "ਸਤਿ ਨਾਮੁ", (1, "x"): "a b"}
    with pytest.raises(ValueError, match="known: x"):
        dictionary.texts(lines, tr, ["y"])


def test_listing(spark):
    todo = spark.createDataFrame([("a",), ("b",)], "unit_id string")
    done = spark.createDataFrame([("a#c0",), ("a#c1",)], "id string")
    assert [r.unit_id for r in listing.remaining(todo, done, "unit_id", "id").collect()] == ["b"]


# -- streams and plans ----------------------------------------------------------------------------------------------------
def test_enforced_budget(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"2024-0{1 + i // 4}-01 00:00:0{i % 4}", 0.4) for i in range(8)], "id long, ts string, usd double").selectExpr("id", "cast(ts AS timestamp) AS ts", "usd")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    got = streams.run_to_memory(streams.enforced(stream, 1.0), "enforced_test", "append", f"{tmp_path}/cp").orderBy("id").collect()
    assert [r.allowed for r in got] == [True, True, False, False] * 2 and {r.month for r in got} == {"2024-01", "2024-02"}


def test_resumed_job_writes_once(spark, tmp_path):
    kind = "unit_id string, text string"
    make = lambda rows: spark.createDataFrame(rows, kind).write.mode("append").parquet(f"{tmp_path}/in")
    for rows in ([("a", "1"), ("b", "2")], [("a", "1"), ("c", "3")]):
        make(rows)
        streams.resumed(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), "unit_id", lambda d: d.withColumn("en", F.upper("text")), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sorted(r.unit_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "c"]


def test_plan():
    works = [{"book": "b1", "work": "w1", "language": "pa"}, {"book": "b2", "work": "w2", "language": "en", "reader": "pdf-text"}]
    steps = pipeline.plan(works, verified=frozenset({"b1"}))
    assert [s.name for s in steps] == ["pages", "ocr", "ocr", "eval", "merge", "ingest", "cite", "embed", "db", "embed", "db", "translate", "embed-en", "db-en"]
    assert pipeline.plan(works, truth=True)[-1].note.startswith("STOP") and "skip" in pipeline.render(pipeline.plan(works, has_corpus=False, translate=False))
    assert [s.name for s in pipeline.between(steps, "cite", "db")] == ["cite", "embed", "db", "embed", "db"]
    ran = []
    jobs = {n: lambda n=n, **k: ran.append(n) for n in pipeline.STEPS}
    assert pipeline.run(steps, jobs) is None and len(ran) == len(steps)
    with pytest.raises(ValueError, match="unknown engine"):
        pipeline.plan(works, engines=["nope"])
    assert os.sep


def test_indic(spark):
    from leafmark.functions import indic

    p = indic.prepared(F.col("t"), "pan")
    got = one(spark, p, t="ਸਤਿ ੧੨ ਨਾਮ me@x.org , www.a.b/12")
    assert got.text == "सति <ID3> नाम <ID2>, <ID1>" and got.entities == ["www.a.b/12", "me@x.org", "12"]
    back = indic.finished(indic.prepared(F.col("t"), "pan")["text"], indic.prepared(F.col("t"), "pan")["entities"], "pan")
    assert one(spark, back, t="ਸਤਿ 12 ਨਾਮ") == "ਸਤਿ 12 ਨਾਮ"
    assert one(spark, indic.restored(F.col("t"), F.array(F.lit("x@y.zz"))), t="a < id 1 > b") == "a x@y.zz b"


def test_group_documents(spark):
    rows = [(1, 1, "line", "a b c"), (1, 2, "rahao", "r s"), (1, 3, "line", "d e f")]
    got = units.group_documents(spark.createDataFrame(rows, "verse_group long, line_id long, kind string, text string"), 5).first()
    assert got.chunks == ["r s a b c", "d e f"]


def test_schemas_parse(spark):
    from leafmark import schemas

    for name, ddl in vars(schemas).items():
        if name.isupper():
            assert spark.createDataFrame([], ddl).columns


def test_crops_stay_on_the_page(spark):
    rows = spark.createDataFrame([(1, 4, 20, 95, 290, 100, 300)], "n int, x0 int, y0 int, x1 int, y1 int, page_w int, page_h int")
    assert tuple(layout.padded_crops(rows).select("x0", "y0", "x1", "y1").first()) == (0, 10, 100, 300)


def test_bench_takes_long_prose_only(spark):
    long = "word " * 9
    rows = [(1, "body", None, long), (2, "body", "en", long), (3, "verse", None, long), (4, "body", None, long + "॥"), (5, "body", None, "short"), (6, None, None, long), (7, "body", "pa", None)]
    got = evaluate.bench_lines(spark.createDataFrame(rows, "n int, style string, lang string, text string"), ["body"], "pa").collect()
    assert [(r.n, r.text) for r in got] == [(1, long.strip())]
    assert evaluate.bench_lines(spark.createDataFrame(rows[:1], "n int, style string, lang string, text string"), ["body"], "en").isEmpty()


def test_render_report_without_new_pages(spark):
    rows = [("a", -2.0, None), ("a", None, False), ("a", 9.0, True), ("b", 1.0, True)]
    got = evaluate.render_report(spark.createDataFrame(rows, "book string, angle double, skipped boolean")).orderBy("book").collect()
    assert [tuple(r) for r in got] == [("a", 2, 1, 1.0, 2.0), ("b", 0, 1, 0.0, 0.0)]


def test_engines_and_what_they_have_to_read(spark):
    out = spark.createDataFrame([("a", 1, "zeta"), ("a", 1, "merged"), ("a", 2, "ink"), ("b", 1, "ink")], "book string, page int, engine string")
    assert {r.book: r.engines for r in listing.engines_with_output(out).collect()} == {"a": ["ink", "zeta", "merged"], "b": ["ink"]}
    truth = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "book string, page int")
    got = {(r.book, r.page, r.engine, r.run) for r in listing.missing_runs(truth, out, {"ink": False, "zeta": True}).collect()}
    assert got == {("a", 1, "ink", True), ("b", 1, "zeta", False)}
    assert {r.run for r in listing.missing_runs(truth, out, {"ink": False, "zeta": True}, paid_too=True).collect()} == {True}


def test_first_available_profile():
    profiles = {"fine": {"dir": "f"}, "base": {"dir": "b"}}
    assert translation.first_available(["other", "fine", "base"], profiles, lambda p: p["dir"] == "b") == "base"
    assert translation.first_available(["fine"], profiles, lambda p: False) is None
