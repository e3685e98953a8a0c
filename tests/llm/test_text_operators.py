"""Classifier, rules, extraction, sharding, codec, licences, mixing and the pipeline."""

import html
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from leafmark.llm import fertility_rules, html_extraction, license_scan, mixing, near_dedup, quality_classifier, sentencepiece_codec, sharding
from leafmark.llm.queries import byte_pattern, tokenizer_path

SF = "/root/testdata/sf0.01"
KIND = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "é ▁ 中 \U0001f600 \x00"), (6, "long " * 40_000), (7, "same"), (7, "same"), (None, "no id")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, extra columns with names the operators use themselves."""
    rows = [(i, t, None, None, None, 1, "x", 0.5, "y") for i, t in ODD]
    return spark.createDataFrame(rows, KIND + ", size int, shard string, score double, ids string")


@pytest.fixture(scope="module")
def proto(spark):
    return sentencepiece_codec.read_model(spark, tokenizer_path())


@pytest.fixture(scope="module")
def both(spark, proto):
    return proto, sentencepiece_codec.read_model(spark, tokenizer_path("byte_bpe_multi_50k.tiktoken")), byte_pattern()


def test_classifier_holds_out(spark, odd):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    held = quality_classifier.scores(docs, model).join(labels, "doc_id").where(quality_classifier.held_out(labels.doc_id)).collect()
    assert len(held) > 40 and sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    got = quality_classifier.scores(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality_classifier.accepted(odd, model).columns == odd.columns
    assert quality_classifier.scores(odd.limit(0), model).count() == 0
    # a flipped label of a held-out row changes nothing
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    again = quality_classifier.fit(docs, flipped)
    assert again.bias == model.bias and (again.word == model.word).all()
    assert quality_classifier.fit(docs, labels.limit(0)).bias == 0


def test_scores_equal_a_plain_softmax():
    import numpy as np
    import pyarrow as pa

    from leafmark.llm import bytetext as B

    texts = ["", "a good plain text about rivers and hills", "naïve café 中文字 déjà vu 😀 ok", "spam spam spam  spam!!\n\tspam", "x"]
    model = quality_classifier.train(pa.array(texts * 3), np.array([1, 1, 1, 0, 0] * 3))

    def gram(text, size):
        out = []
        for i in range(len(text) - size + 1):
            g = [32 if c in " \t\n\v\f\r" else ord(c) for c in text[i : i + size]]
            if 32 in g[1:-1] or g[0] == g[-1] == 32:
                continue
            x = 0x9747B28C + size
            for c in g:
                x = ((x ^ c) * 0x01000193) & 0xFFFFFFFF
            x ^= x >> 15
            x = (x * 0x2C1B3C6D) & 0xFFFFFFFF
            out.append((x ^ x >> 13) % quality_classifier.BUCKETS)
        return out

    for _, _, buf, offsets in B.chunks(pa.array(texts)):
        got = quality_classifier.score_chunk(model, buf, offsets)
        for i, t in enumerate(texts):
            one = np.frombuffer(t.encode(), np.uint8)
            words, _ = quality_classifier._word_buckets(one, np.array([0, len(one)]))
            grams = gram(t, 2) + gram(t, 3)
            z = model.bias + (model.word[words].mean() if len(words) else 0) + (model.gram[grams].mean() if grams else 0)
            assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-5
    points, at = B.characters(np.frombuffer("aé中😀b".encode(), np.uint8), np.array([0, 3, 11]))
    assert points.tolist() == [97, 0xE9, 0x4E2D, 0x1F600, 98] and at.tolist() == [0, 2, 5]


def base(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines, dup, seen = (t or "").split("\n"), 0, set()
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(hit)


def test_rules_count_as_brute_force(spark, odd, both):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "b ", "\n", "é", "#", "\t", "ab ab ", "x y z w v u t s r "]) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = fertility_rules.rules(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], KIND), *both).collect()
    for r in got:
        want = base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)
    got = fertility_rules.rules(odd, *both).collect()
    assert len(got) == len(ODD) and not any(r.kept for r in got if r.n_words < 20)


def test_rules_part_good_from_bad(spark, both):
    rows = fertility_rules.rules(spark.read.parquet(f"{SF}/documents.parquet"), *both).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("n_words >= 20").collect()
    good, bad = [r for r in rows if r.quality], [r for r in rows if not r.quality]
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_measures_equal_the_libraries(spark, both):
    import math

    import sentencepiece
    import tiktoken

    other = fertility_rules.ByteVocabulary(*both[1:])
    sp = sentencepiece.SentencePieceProcessor(model_proto=both[0])
    assert isinstance(other.encoding, tiktoken.Encoding) and other.count("x" * 9000) > 0
    rows = [r for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 9 = 0").collect() if r.text.split()]
    got = {r.doc_id: r for r in fertility_rules.rules(spark.createDataFrame(rows), *both).collect()}
    for r in rows:
        ids, m = sp.encode(r.text), got[r.doc_id]
        counts = Counter(ids)
        h = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values())
        assert m.n_tokens == len(ids) and abs(m.tokens_per_word - len(ids) / m.n_words) < 1e-9 and abs(m.chars_per_token - len(r.text) / len(ids)) < 1e-9
        assert abs(m.byte_share - sum(sp.is_byte(i) for i in ids) / len(ids)) < 1e-9 and abs(m.min_entropy + math.log2(max(counts.values()) / len(ids))) < 1e-9
        assert abs(m.entropy_share - h / max(1.0, math.log2(min(3000, len(ids))))) < 1e-9
        assert abs(m.other_chars - len(r.text) / len(other.encoding.encode_ordinary(r.text))) < 1e-9


def test_rules_know_scripts(spark, both):
    texts = {
        "greek": "Η κυβέρνηση ανακοίνωσε σήμερα νέα μέτρα για την οικονομία, ενώ η αντιπολίτευση ζητά πρόωρες εκλογές. Οι πολίτες περιμένουν με αγωνία τις επόμενες ημέρες, καθώς οι τιμές στα καταστήματα ανεβαίνουν συνεχώς.",
        "arabic": "أعلنت الحكومة اليوم عن إجراءات جديدة لدعم الاقتصاد بينما طالبت المعارضة بإجراء انتخابات مبكرة في البلاد. وقال رئيس الوزراء إن الأسعار سوف تنخفض قريبا وإن المدارس ستفتح أبوابها في الشهر القادم.",
        "cyrillic": "Правительство объявило сегодня о новых мерах по поддержке экономики, а оппозиция требует досрочных выборов. Министр сказал, что цены в магазинах скоро снизятся, и школы откроются в следующем месяце как обычно.",
        "hebrew": "הממשלה הודיעה היום על צעדים חדשים לתמיכה בכלכלה ואילו האופוזיציה דורשת בחירות מוקדמות. ראש הממשלה אמר כי המחירים בחנויות ירדו בקרוב וכי בתי הספר ייפתחו בחודש הבא כרגיל.",
        "latin": "Il governo ha annunciato oggi nuove misure per sostenere la crescita del paese, mentre chi sta dall'altra parte chiede di votare prima. Il ministro ha detto che presto i prezzi nei negozi scenderanno e le scuole apriranno.",
        "indic": "सरकार ने आज अर्थव्यवस्था के लिए नए उपायों की घोषणा की जबकि विपक्ष ने जल्दी चुनाव की मांग की। मंत्री ने कहा कि दुकानों में दाम जल्द कम होंगे और स्कूल अगले महीने खुलेंगे।",
    }
    assert {k: fertility_rules.script_of(t) for k, t in texts.items()} == {k: k for k in texts} and fertility_rules.script_of("12 !") == "other"
    rows = [(i, t, None, "s", 0) for i, t in enumerate(texts.values())] + [(90, "qzx " + "x9Q#zK7 vB@3pL kk8!wR2 " * 1 + " ".join(f"Zq{k}xX9vW{k * 7}kJ" for k in range(40)), None, "s", 0)]
    got = {r.doc_id: r.kept for r in fertility_rules.rules(spark.createDataFrame(rows, KIND), *both).collect()}
    assert got == {i: True for i in range(len(texts))} | {90: False}


PAGE = """<html><head><title>T</title><style>p{{}}</style><script>if (a < b) "</p>"</script></head><body><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li><li>About</li></ul></nav>
<div class="notice cookie-bar">We use cookies</div>{0}<aside class="sidebar">See also</aside><div id="comments"><p>nice post</p></div><form><input value=x> Search</form><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("body", ["<article><h1>A &amp; B</h1>{}</article>", "<main>{}</main>", '<div class="layout no-sidebar"><article>{}</article></div>', '<div class="content">{}</div>', '<div id="post-12" class="entry">{}</div>', "<div>{}</div>"])
def test_extraction_keeps_the_article(spark, body):
    paras = [[f"First {k} text of <b>bold</b> words<br>and more &lt;{k}&gt;", f"Second\n  one {k * 7}", *(f"Extra {k} {j} with some longer text to read" for j in range(k % 3))] for k in range(8)]
    pages = [(k, f"http://host{k % 2}.example/{k}", PAGE.format(body.format("".join(f"<p>{x}" + ("</p>" if j % 2 else "") for j, x in enumerate(p))))) for k, p in enumerate(paras)]
    pages += [(90, None, None), (91, "http://lone.example/", "<p>alone &amp; well"), (92, "x", ""), (93, "http://cut.example", "<article><p>kept &am</p><p>cut <b"), (91, "http://lone.example/", "<p>alone &amp; well")]
    frame = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, text string")
    got = html_extraction.extracted(frame).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    for k, p in enumerate(paras):
        want = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in p]
        assert text[k].replace("A & B\n\n", "") == "\n\n".join(want)
    assert (text[90], text[91], text[92], text[93]) == ("", "alone & well", "", "kept &am\n\ncut")
    assert html_extraction.extracted(frame.limit(0)).count() == 0


def test_raw_and_unclosed_elements_end():
    rest = "<body><article><p>one text</p><p>two</p></article></body></html>"
    for start in ("<html><head><script>for(var i=0;i<n;i++){f(i)}</script></head>", "<html><head><style>a<b{}</STYLE ></head>", "<html><head><title>a<b</title>", "<html><head><meta charset=x>",
                  "<html><head></head><body><script>if(i<n)g('</p>')</SCRIPT>", "<html><body><form><select><option>a<option>b</select></form>", "<html><body><div><button>go</div>", "<html><body><div><option>a</div>", "<html><body><noscript><p>on</p></noscript>", "<html><body><button><p>go</p></button>", "<html><body><div><button>go<button>on</div>", "<html><head><script src=x /></head>"):
        assert html_extraction._text(start + rest, None) == "one text\n\ntwo", start


def test_markup_inside_articles():
    text = lambda body: html_extraction._text(f"<html><body><nav>menu</nav><article>{body}</article></body></html>", None)
    assert text("<p title=don't>first</p><p>mid</p><p title=won't>more</p>") == "first\n\nmid\n\nmore"
    assert text("<p data-x='a>b' title = \"c>d\">one</p>") == "one"
    assert text("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be</p>") == "let x=2 be"
    assert text('<p>one</p><div class="related-work">two</div><div id="alert">three</div><address>four</address>') == "one\n\ntwo\n\nthree\n\nfour"
    assert text('<p>one</p><div class="ad">x</div><div class="ad-slot top">x</div><div id="comments"><p>x</p></div><div class="related-posts">x</div><div class="share buttons">x</div><aside>x</aside>') == "one"


def test_the_host_decides():
    page = "<html><body><div><h4>Company page</h4><div>{}</div><div>{}</div><h5>Terms apply to all of this</h5></div></body></html>"
    article = "<html><body><article><h1>Report</h1><p>{}</p><div>Reprint only with leave</div></article></body></html>"
    for form, alone, shared in ((page, "Company page\n\n{0}\n\n{0} on\n\nTerms apply to all of this", "{0}\n\n{0} on"), (article, "Report\n\n{0}\n\nReprint only with leave", "Report\n\n{0}")):
        pages = [form.format(f"words of page {k}", f"words of page {k} on") for k in range(6)]
        own = None
        for x in pages:
            tree = html_extraction.wrapper_of(html_extraction.parse(x))
            own = html_extraction.merged(own, tree) if own else tree
        own = html_extraction.labelled(own)
        for k, x in enumerate(pages):
            assert html_extraction._text(x, None) == alone.format(f"words of page {k}")
            assert html_extraction._text(x, own) == shared.format(f"words of page {k}")


def test_pages_of_a_host_with_several_templates():
    page = "<html><body><nav><a href=/>Home</a></nav>{}<footer>me</footer></body></html>"
    kinds = ["<article><p>{}</p></article>", "<div class=content><p>{}</p></div>", "<div><p>{}</p></div>"]
    pages = [(page.format(kinds[k % 3].format(f"text {k} of a page")), f"text {k} of a page") for k in range(30)]
    own = None
    for html_, _ in pages:
        tree = html_extraction.wrapper_of(html_extraction.parse(html_))
        own = html_extraction.merged(own, tree) if own else tree
    own = html_extraction.labelled(own)
    assert [html_extraction._text(html_, own) for html_, _ in pages] == [want for _, want in pages]


def test_sharding_matches_the_walk(spark, odd):
    nodes = sharding.ring(8)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 501")
    got = sharding.sharded(docs).collect()
    spots = {r.doc_id: r.s for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id, 4), {sharding._SPACE}) AS s").collect()}
    # the sequential rule, key by key: own arcs first, then what overflows, arc by arc
    edges = [p for p, _ in nodes]
    arcs = [[] for _ in nodes]
    for i, s in spots.items():
        k = next((k for k, p in enumerate(edges) if s <= p), len(edges))
        arcs[k % len(nodes)].append((k >= len(edges), s, i))
    room, used, place, over = sharding.capacities(len(spots), 8), [0] * 8, {}, []

    def put(i, shard):
        place[i] = (shard, used[shard])
        used[shard] += 1
        room[shard] -= 1

    for k, arc in enumerate(arcs):
        for _, _, i in sorted(arc):
            put(i, nodes[k][1]) if room[nodes[k][1]] else over.append((k, i))
    for k, i in over:
        put(i, next(nodes[(k + j) % len(nodes)][1] for j in range(1, len(nodes)) if room[nodes[(k + j) % len(nodes)][1]]))
    assert {r.doc_id: (r.shard, r.slot) for r in got} == place
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())
    out = sharding.sharded(odd).collect()
    assert len(out) == len(ODD) and {r.size for r in out if r.doc_id in (1, 2)} == {1}
    assert sharding.sharded(odd.limit(0)).count() == 0


def test_sharding_moves_little():
    before, after = sharding.ring(8), sharding.ring(9)
    spots = [random.Random(k).randrange(sharding._SPACE) for k in range(4000)]
    moved = [(a, b) for s in spots if (a := sharding.shard_of(s, before)) != (b := sharding.shard_of(s, after))]
    assert len(moved) < 0.25 * len(spots) and {b for _, b in moved} == {8}


def test_codec_equals_the_library(spark, odd, proto):
    import sentencepiece

    sp, own = sentencepiece.SentencePieceProcessor(model_proto=proto), sentencepiece_codec.Codec(proto)
    rng = random.Random(7)
    parts = ["a", "the ", " ", "  ", "\n", "▁", "é", "中", "\U0001f600", "\t", "\r", "</s>", "<0x41>", "\x00", "​", "tion", " in"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for t in texts:
        ids, starts, ends = own.encode(t)
        assert ids.tolist() == sp.encode(t) and own.decode(ids.tolist()) == sp.decode(sp.encode(t))
        source = t.encode()
        assert b"".join(source[a:b] for a, b in zip(starts, ends, strict=True)) == source
    rows = sentencepiece_codec.digested(odd, proto).collect()
    assert len(rows) == len(ODD) and all(r.spans_tile for r in rows)
    assert all(r.n_tokens == len(sp.encode(dict(ODD)[r.doc_id] or "", add_eos=True)) for r in rows)
    import hashlib

    for r in rows:
        ids = sp.encode(dict(ODD)[r.doc_id] or "", add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    back = sentencepiece_codec.decoded(sentencepiece_codec.encoded(odd, proto), proto).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((i or -1, (t or "").replace("▁", " ")) for i, t in ODD)  # the mark itself decodes to a space
    assert sentencepiece_codec.digested(odd.limit(0), proto).count() == 0


def test_codec_reads_compiled_character_maps(proto):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    rng = random.Random(9)
    parts = ["a", " ", "  ", "é", "ﬁ", "Å", "ｶﾞ", "①", "㌀", "　", "A", "İ", "\t", "\n", "▁"]
    for rule in ("nmt_nfkc", "nfkc", "nmt_nfkc_cf"):
        made = pb.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        model = pb.ModelProto.FromString(proto)
        model.normalizer_spec.CopyFrom(made.normalizer_spec)
        model.normalizer_spec.add_dummy_prefix = model.normalizer_spec.remove_extra_whitespaces = True
        sp, own = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()), sentencepiece_codec.Codec(model.SerializeToString())
        for _ in range(500):
            t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
            ids, starts, ends = own.encode(t)
            assert ids.tolist() == sp.encode(t) and own.decode(ids.tolist()) == sp.decode(ids.tolist())
            assert (starts[1:] == ends[:-1]).all() and (starts <= ends).all()


def test_licences(spark, odd):
    texts = {1: "x\nReleased under the MIT License.\ny", 2: "Licensed under the Apache License, Version 2.0. All rights reserved.", 3: "this is about a license", 4: None,
             5: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
             6: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.licences for r in license_scan.scan(frame).collect()}
    assert got == {1: "MIT", 2: "Apache-2.0|all-rights-reserved", 3: "", 4: "", 5: "MIT", 6: ""}
    assert license_scan.scan(odd).count() == len(ODD) and license_scan.scan(odd.limit(0)).count() == 0


def test_wrapped_licences(spark):
    import textwrap

    grant, notice = (license_scan.SENTENCES[k][0].capitalize() for k in ("mit-grant", "mit-notice"))
    mit = f"{grant}:\n\n{notice}."
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
    names = "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."

    def wrap(text, mark="", width=72):
        return "\n".join((mark + line).rstrip() for part in text.split("\n") for line in textwrap.wrap(part, width) or [""])

    texts = {1: "MIT License\nCopyright (c) 2020 me\n\n" + wrap(mit), 2: wrap(bsd, " * "), 3: wrap(bsd + names, "# "), 4: wrap(gpl.format(";", 2), "// ").replace("\n", "\r\n"), 5: "/*\n" + wrap(gpl.format(",", 3), " * ", 40) + "\n */",
             6: "a heading\nReleased under the\nMIT License.\nmore", 7: "This   program is free    software; " + gpl.format(",", 3)[31:].replace(" ", "  "), 8: "Released under the\n\nMIT License.", 9: "not\nreally released under the\nMIT License",
             10: wrap(mit, "REM "), 11: "... \n" + "." * 100_000 + " licence " + "- " * 50_000}
    got = {r.doc_id: r.licences for r in license_scan.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "BSD-2-Clause", 3: "BSD-3-Clause", 4: "GPL-2.0-or-later", 5: "GPL-3.0-or-later", 6: "MIT", 7: "GPL-3.0-or-later", 8: "", 9: "", 10: "MIT", 11: ""}


def test_licences_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    want = {tuple(r) for r in con.sql(f"SELECT doc_id, n_known, sentence_ids, licences FROM ({license_scan.oracle()})").fetchall()}
    assert {tuple(r) for r in license_scan.scan(spark.read.parquet(f"{SF}/documents.parquet")).collect()} == want


def test_mixing_meets_targets(spark, odd):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    weights = {"clean": 0.97, "junk": 0.02, "toxic": 0.01}
    rows = mixing.mixed(docs, labels, weights).collect()
    total = sum(r.n_tokens for r in rows)
    assert len(rows) == docs.count()
    for d, w in weights.items():
        given = sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows)
        assert abs(given - w * total) < 0.01 * total and all(r.rate >= 0 for r in rows)
    assert all(abs(sum(r[f"p_{d}"] for d in weights) - 1) < 1e-9 for r in rows)
    for frame in (odd, odd.limit(0)):
        assert mixing.mixed(frame, labels, weights).count() == frame.count()
        assert mixing.mixed(frame, labels.limit(0), weights).count() == frame.count()
    assert mixing.mixed_documents(odd, labels, {"toxic": 0.0}).columns == odd.columns


def test_mixing_is_native(spark):
    frame = mixing.mixed(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), {"clean": 1.0})
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline as P

    from .test_dedup import components, near, norm, shingles

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:3]:
        frame = stage(spark, docs, sf)
        assert frame.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in frame.collect()}
        docs = spark.createDataFrame(frame.collect(), docs.schema)
    first = {}
    for i, t in sorted(kept["quality classifier"].items()):
        first.setdefault(norm(t), i)
    assert set(kept["exact dedup"]) == set(first.values())
    root = components({i: shingles(t) for i, t in kept["exact dedup"].items()}, near(80))
    assert set(kept["near dedup"]) == {i for i, r in root.items() if i == r}
    out = P.run(spark, sf).collect()
    assert {r.doc_id for r in out} <= set(kept["near dedup"]) and all(len(r.ids_sha256) == 64 for r in out)


def test_passes_get_bounded_batches(spark):
    from leafmark.llm import scratch

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    try:
        rows = spark.range(0, 9000, 1, 1).selectExpr("id", "repeat('x', CASE WHEN id = 5000 THEN 9000000 ELSE 4000 END) AS text")
        got = scratch.passed(rows, sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 9000
        assert all(r.size <= 1.1 * scratch.BATCH or r.size < 9_000_000 + 1.1 * scratch.BATCH and r.n < 2000 for r in got) and sum(r.size > 1.1 * scratch.BATCH for r in got) == 1
        spark.conf.set(name, "1m")
        assert all(r.size <= 1.1 * (1 << 20) for r in scratch.passed(rows.where("id < 5000"), sizes, "n long, size long").collect())
        spark.conf.set(name, before)
        model = quality_classifier.Model(np.zeros(quality_classifier.BUCKETS, np.float32), np.zeros(quality_classifier.BUCKETS, np.float32), 1.0)
        for make in (lambda: quality_classifier.accepted(rows, model), lambda: near_dedup.near_duplicates(rows.limit(0).withColumnRenamed("id", "doc_id"))):
            spark.conf.set(name, before)
            make()
            assert int(spark.conf.get(name).rstrip("b")) == scratch.BATCH
    finally:
        spark.conf.set(name, before)


def test_ids_of_many_texts_are_learnt_at_once(proto, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece_codec, "CACHE", 40)
    sp, codec = sentencepiece.SentencePieceProcessor(model_proto=proto), sentencepiece_codec.Codec(proto)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé中") for _ in range(rng.randint(1, 9))) for _ in range(150)] + ["x" * 200, "a\nb", "é\n中\na", "é" * 70]
    calls, encode = [], codec.pieces.encode

    def counted(*a, **b):
        calls.append(a)
        return encode(*a, **b)

    monkeypatch.setattr(codec.pieces, "encode", counted)
    for turn in range(6):  # the cache overflows between turns
        texts = [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(30)]
        got = codec.ids_of(texts)
        assert len(calls) <= turn + 1
        assert [g.tolist() for g in got] == [sp.encode(t) for t in texts]
        assert len(codec.packed) <= 40 and not any(len(w) > sentencepiece_codec.LONGEST for w in [*codec.packed, *codec.packed_old])
    odd = [t for _, t in ODD] + ["two  spaces", " first", "\nline", "a\n\n b \n", "last ", "tab\tin"]
    assert [g.tolist() for g in codec.ids_of(odd)] == [sp.encode(t or "") for t in odd] and codec.ids_of([]) == []
