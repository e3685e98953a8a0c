"""Steps that must hold on large tables: the same rows by every path, and little shuffled."""

import random
import time

import pytest
from pyspark.sql import functions as F

from leafmark.functions import text as X
from leafmark.operators import alignment, citations, evaluate, fusion, lexicon, pdf_lines, words
from leafmark.plans import text_queries
from leafmark.sources import engines


def _texts(n, seed):
    draw = random.Random(seed)
    words = [a + b + c for a in "bdg" for b in "aeiou" for c in "klm"]
    return [" ".join(draw.sample(words, draw.randint(3, 18))) for _ in range(n)]


@pytest.mark.parametrize("slack, share", [(None, 0.0), (None, 0.45), (1, 0.0)])
def test_overlaps_of_small_and_large_corpora_are_those_of_brute_force(spark, slack, share):
    q, c = _texts(40, 1), _texts(30, 2)
    quotes = citations.with_tokens(spark.createDataFrame([("w", 1, i, t, i % 6) for i, t in enumerate(q)], "work string, page long, para_no long, text string, ang int"))
    lines = citations.with_tokens(spark.createDataFrame([(i, i // 3, i % 6, t) for i, t in enumerate(c)], "line_id long, verse_group long, ang long, text string"))
    want = {(i, k, len(set(x.split()) & set(y.split()))) for i, x in enumerate(q) for k, y in enumerate(c) if len(set(x.split()) & set(y.split())) >= max(4, share * len(set(y.split()))) and (slack is None or abs(i % 6 - k % 6) <= slack)}
    for bound in (0, 10**6):
        got = citations.overlaps(quotes, lines, share, bound) if slack is None else citations.near_overlaps(quotes, lines, slack, bound)
        rows = [(r.para_no, r.line_id, r.shared) for r in got.collect()]
        assert len(rows) == len(want) and set(rows) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "any_value" not in plan and "first(" not in plan  # words of both sides must not go through the shuffle of pairs


def _exchanged(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_symbols_of_pages_in_any_order_are_packed_before_the_shuffle(spark):
    draw, rows = random.Random(3), []
    for page in [*range(40), None]:
        rows += [(page, k, draw.choice(["a", "b ", "", "ਸਤਿ", None]), draw.choice([0, 0, 0, 1, 2, 3, 5, None]), draw.choice([k, None]), 0, k + 9, 30) for k in range(draw.randint(1, 30))]
    draw.shuffle(rows)
    want = {}
    for page in {r[0] for r in rows}:
        line = 0
        for _, k, text, brk, x0, _, x1, _ in sorted((r for r in rows if r[0] == page), key=lambda r: r[1]):
            own = want.setdefault((page, line), ["", [], []])
            own[0] += "" if text is None else text + " " * (brk in (1, 2))
            own[1] += [x0] * (x0 is not None)
            own[2].append(x1)
            line += brk in (3, 5)
    kind = "page long, seq long, text string, brk int, x0 int, y0 int, x1 int, y1 int"
    got = engines.lines_of_symbols(spark.createDataFrame(rows, kind).repartition(7), ["page"])
    assert {(r.page, r.line): (r.text, r.x0, r.x1) for r in got.collect()} == {k: (t.strip(" "), min(a, default=None), max(b)) for k, (t, a, b) in want.items()}
    assert "Window" not in _exchanged(got) and "seq" not in _exchanged(got).split("Exchange")[0]
    nested = spark.createDataFrame([(p, [dict(zip("seq text brk x0 y0 x1 y1".split(), r[1:], strict=True)) for r in rows if r[0] == p]) for p in range(40)], "page long, symbols array<struct<seq:long,text:string,brk:int,x0:int,y0:int,x1:int,y1:int>>")
    again = engines.lines_of_symbols(nested.unionByName(nested.limit(0)), ["page"]).collect()
    assert sorted(tuple(r) for r in again) == sorted(tuple(r) for r in got.where("page is not null").collect())


def test_words_of_pages_in_any_order_make_the_lines_of_their_boxes(spark):
    draw = random.Random(4)
    rows = [(p, draw.choice([1, 2, None]), 0, draw.randint(0, 3), w, draw.randint(0, 9) * 10, draw.randint(0, 4), 7, 5, draw.choice(["x", "yy", " "]), draw.choice([-1.0, 50.0, 75.5])) for p in range(30) for w in range(25)]
    draw.shuffle(rows)
    kept = [r for r in rows if r[9].strip() and r[10] >= 0]
    want = {}
    for p in range(30):
        groups = {}
        for r in (r for r in kept if r[0] == p):
            groups.setdefault((r[1] is not None, r[1], r[3]), []).append(r)
        lines = [(min(r[6] for r in g), min(r[5] for r in g), k, " ".join(r[9] for r in sorted(g, key=lambda r: (r[5], r[4], r[9]))), max(r[5] + r[7] for r in g)) for k, g in groups.items()]
        lines.sort(key=lambda x: (x[0], x[1], x[2][0], x[2][1] or 0, x[2][2]))
        want |= {(p, n): (k[1], k[2], text, x1) for n, (_, _, k, text, x1) in enumerate(lines, 1)}
    kind = "page long, block int, par int, line int, word int, left int, top int, width int, height int, text string, conf double"
    got = engines.lines_of_words(spark.createDataFrame(rows, kind).repartition(5), ["page"])
    assert {(r.page, r.n): (r.block, r.line, r.text, r.x1) for r in got.collect()} == want
    assert "collect_list" not in _exchanged(got) and "Window" not in _exchanged(got)


def test_pdf_lines_join_runs_as_they_were_joined_one_by_one(spark):
    draw = random.Random(5)
    rows = [(p, float(draw.randint(0, 300)), 700.0 - draw.randint(0, 9) * 1.7, draw.choice([9.0, 10.5]), draw.random() < 0.4, draw.choice(["", " ", "ab", "c ", " d", "long word"]), draw.choice([None, 20.0]), draw.choice([None, 0.0, 3.0])) for p in range(25) for _ in range(40)]
    want = {}
    for p in range(25):
        lines = []
        for r in sorted((r for r in rows if r[0] == p), key=lambda r: (-r[2], r[1])):
            if lines and abs(lines[-1][0][2] - r[2]) <= 2.5:
                lines[-1].append(r)
            else:
                lines.append([r])
        for n, line in enumerate(lines, 1):
            own = sorted(line, key=lambda r: r[1])
            text = pdf_lines.joined([pdf_lines.Run(r[1], r[3], r[5], r[6], r[7]) for r in own])
            want[p, n] = (line[0][2], own[0][1], sum(len(r[5]) for r in own if r[4]) > sum(len(r[5]) for r in own) / 2, text)
    frame = spark.createDataFrame(rows, "page long, x double, y double, size double, italic boolean, text string, width double, space double").coalesce(1)
    got = pdf_lines.lines_of(frame, ["page"])
    assert {(r.page, r.n): (r.y, r.x0, r.italic, r.text) for r in got.collect()} == want
    assert "FlatMapGroups" not in _exchanged(got)
    with_ = pdf_lines.with_margin(got, ["page"])
    assert sorted((r.page, r.margin) for r in with_.select("page", "margin").distinct().where("margin is not null").collect()) == sorted(tuple(r) for r in pdf_lines.left_margin(got, ["page"]).collect())


def _edits(a, b):
    """Edit script by a whole table, ties as alignment states them."""
    d = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    i, j, out = len(a), len(b), []
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out += [("replace", i, j)] if a[i] != b[j] else []
        elif i and d[i][j] == d[i - 1][j] + 1:
            i -= 1
            out.append(("delete", i, j))
        else:
            j -= 1
            out.append(("insert", i, j))
    return out[::-1]


def test_edit_scripts_of_few_edits_need_no_whole_table():
    draw = random.Random(6)
    for t in range(600):
        a = [draw.choice("ab" if t % 3 else "abcde") for _ in range(draw.randint(0, 20))]
        b = list(a) if t % 2 else [draw.choice("abc") for _ in range(draw.randint(0, 20))]
        for _ in range(draw.randint(0, 4)):
            b[draw.randint(0, len(b)) : draw.randint(0, len(b))] = draw.choice(["", "c", "ab"])
        assert alignment.edit_ops(a, b) == alignment.edit_ops("".join(a), "".join(b)) == _edits(a, b)
        assert alignment.distance(a, b) == len(_edits(a, b))
    a = "".join(draw.choice("abcdefgh") for _ in range(20_000))
    b = a[:5_000] + "x" + a[5_001:15_000] + a[15_002:]
    began = time.time()
    assert [o[0] for o in alignment.edit_ops(a, b)] == ["replace", "delete", "delete"]
    assert time.time() - began < 4  # a table has 400 million cells


def test_positional_votes_of_many_lines(spark):
    draw, rows = random.Random(7), []
    for n in range(60):
        k, size = draw.randint(0, 4), draw.randint(0, 12)
        rows.append((n, [([draw.choice(["a", "b", "ਸਤਿ", None]) for _ in range(size + draw.randint(-1, 1) * (i > 0))] if size else [], draw.choice([0.5, 0.7]), draw.choice([None, 0.9])) for i in range(k)]))
    got = fusion.positional_vote(spark.createDataFrame(rows, "n int, readings array<struct<items:array<string>,weight:double,conf:double>>"))
    assert "arrow" in got._jdf.queryExecution().executedPlan().toString().lower()
    found = {r.n: (r.text, r.same) for r in got.collect()}
    for n, readings in rows:
        text, same = "", 0
        for i in range(len(readings[0][0]) if readings else 0):
            at = [r[0][i] if i < len(r[0]) else None for r in readings]
            w = [r[1] * (0.8 if r[2] is None else r[2]) + 1e-6 * (not k) for k, r in enumerate(readings)]
            support = [round(sum(w[j] for j in range(len(at)) if at[j] == x and x is not None), 9) for x in at]
            text += max(zip(support, (-k for k in range(len(at))), at, strict=True), key=lambda s: s[:2])[2] or ""
            same += None not in at and len(set(at)) == 1
        assert found[n] == (text, same)


def test_error_rates_of_plain_and_other_scripts(spark):
    pairs = [("a  “b” c`s", "a 'b' c's"), ("ਸਤਿ ਨਾਮੁ", "ਸਤ ਨਾਮੁ x"), ("naïve, (text)", "naive text!"), (None, "x"), ("éa", "éa"), (" ".join(f"w{i}" for i in range(9000)), " ".join(f"w{i}" for i in range(1, 9001)))]
    rows = spark.createDataFrame([("e", str(k), a, b) for k, (a, b) in enumerate(pairs)], "engine string, kind string, ref string, hyp string")
    got = {r.kind: (r.edits, r.chars, r.word_edits, r.words) for r in evaluate.error_rates(rows).where("kind is not null").collect()}
    assert [got[str(k)][0] for k in range(5)] == [2, 3, 4, 1, 1] and [got[str(k)][2:] for k in range(6)] == [(0, 3), (2, 2), (1, 2), (1, 0), (1, 1), (2, 9000)]
    assert [got[str(k)][1] for k in range(5)] == [9, 5, 13, 0, 2]


def test_corrections_price_only_words_one_apart(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abceo") for _ in range(draw.randint(1, 6)))
    asked, known, prices = sorted({word() for _ in range(120)}), sorted({word() for _ in range(120)}), {"c>e": 0.3, "e>o": 0.4, "rn>m": 0.2}
    confused = {"c": "ce", "e": "eco", "o": "oe"}
    want = {}
    for w in asked:
        costs = sorted((c, k) for k in known if k[0] in confused.get(w[0], w[0]) and abs(len(k) - len(w)) <= 1 and (c := lexicon.weighted_distance(list(w), list(k), prices, 1.5)) <= 1.5)
        if costs:
            best = costs[0]
            want[w] = (best[1], "too far" if best[0] > 1 else "ambiguous" if len(costs) > 1 and costs[1][0] - best[0] < 0.5 else "corrected")
    frames = [spark.createDataFrame([(w,) for w in ws], "word string") for ws in (asked, known)]
    assert {r.word: (r.best, r.verdict) for r in lexicon.corrections(*frames, prices).collect()} == want
    few = lexicon._one_apart(frames[0].selectExpr("word", "array(left(word, 1)) AS firsts", "length(word) AS n"), frames[1], prices).count()
    assert few * 2 < sum(w[0] == k[0] and abs(len(w) - len(k)) <= 1 for w in asked for k in known)
    assert lexicon.corrections(*frames, prices, limit=2.0).count() >= len(want)  # two edits: by first character and length


def test_texts_without_a_sentence_have_no_first_and_no_last(spark, tmp_path):
    spark.createDataFrame([(1, ""), (2, " \n "), (3, None), (4, "One. Two!")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n, r.first, r.last) for r in text_queries.sentence_split(spark, str(tmp_path)).collect()}
    assert got == {1: (0, None, None), 2: (0, None, None), 3: (None, None, None), 4: (2, "One.", "Two!")}


def test_words_of_any_script_are_cut_as_the_jvm_cuts_them(spark):
    texts = [None, "", "  a\tb  ", "(one) “two”, three... ॥", "x´s `q` ­-soft", "ਸਤਿ (ਨਾਮੁ)", "naïve – word", "--- .", "a b c​d", "1999. 'tis"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    assert all(r.a == r.b for r in rows.select(words.words(F.col("text")).alias("a"), X.words(F.col("text")).alias("b")).collect())
    lines = spark.createDataFrame([(k, [t, u, None]) for k, (t, u) in enumerate([("a b b", "b c"), ("ਸਤਿ x", "ਸਤਿ y"), ("(b) d", "b! d")])], "k int, readings array<string>")
    got = lexicon.book_vocab(lines, ["k"], 1)
    assert {(r.word, r.n) for r in got.collect()} == {("b", 2), ("ਸਤਿ", 1), ("d", 1)}
    assert "hashpartitioning(k#" not in _exchanged(got)


def test_adopted_orphans_of_many_pages(spark):
    draw = random.Random(9)
    rows = [(p, n, 0, (y := draw.randint(0, 200)), 9, y + draw.randint(1, 40), "t") for p in range(30) for n in range(20)]
    want = set()
    for p in range(30):
        taken = []
        for r in sorted((r for r in rows if r[0] == p), key=lambda r: (r[3], r[2], r[1])):
            if all(max(0, min(r[5], b) - max(r[3], a)) / max(1, min(r[5] - r[3], b - a)) < 0.4 for a, b in taken):
                taken.append((r[3], r[5]))
                want.add(r[:2])
    got = fusion.adopted(spark.createDataFrame(rows, "page long, n long, x0 int, y0 int, x1 int, y1 int, text string").repartition(6), ["page"])
    assert {(r.page, r.n) for r in got.collect()} == want and got.columns[:2] == ["page", "n"]
    assert "FlatMapGroups" not in _exchanged(got)


def test_quotations_cut_by_pages_are_joined_though_works_are_dealt_out(spark):
    body = "and onward the river carries every traveller homeward ||1|| Pause ||"
    rows = [("w", 1, 1, "plain"), ("w", 1, 2, '"A quotation opens on this page'), ("w", 2, 1, body), ("w", 3, 5, '"Another opens here'), ("w", 3, 6, body), ("w", 4, 1, body), ("v", 4, 1, body)]
    frame = spark.createDataFrame([(*r, "body") for r in rows], "work string, page long, para_no long, text string, style string")
    found = citations.detect(frame)
    assert {(r.work, r.page, r.para_no): (r.opened_page, r.opened_para) for r in found.collect()} == {("w", 2, 1): (1, 2), ("w", 3, 6): (3, 5), ("w", 4, 1): (None, None), ("v", 4, 1): (None, None)}
    plan = _exchanged(found)
    assert not [x for x in plan.splitlines() if "lag(" in x and "style" in x and "[work#" in x and "page" not in x]
