"""Entities that operators exchange, as DDL; readers use these, none is inferred.  Boxes are pixels with y down."""

BOX = "x0 int, y0 int, x1 int, y1 int"
PAGE = "book string, page long, file string, w int, h int, angle double, bleed boolean"
LINE = f"book string, engine string, page long, n long, {BOX}, text string, conf double, zone string, words array<struct<x0:int,y0:int,x1:int,y1:int,text:string,conf:double>>"
MERGED = f"book string, page long, n long, {BOX}, text string, kind string, col int, bold boolean, agreement double, oov double, n_words int, conf double, route string, raw map<string,string>"
CORPUS_LINE = "line_id long, verse_group long, ang long, text string, source string, kind string"
TRANSLATION_LINE = "line_id long, translator string, text string"
MATCH = "qid long, line_id long, score double, start int, end int, runner_up double, method string"
TRUTH = f"id string, page long, n long, {BOX}, kind string, text string, line_id long, source string, verified boolean"
PARAGRAPH = "unit_id string, work string, part string, page long, para_no long, marker string, style string, italic boolean, text string, lang string, line_ids array<long>, verse_group long, ang long, match_score double, routed boolean"
CITATION = "work string, page long, para_no long, verse_group long, line_id long, score double, second double, status string"
UNIT = "unit_row long, work string, seq long, part string, page long, para_no long, text string, text_src string, cites array<string>, words long"
VECTOR = "unit_row long, codes array<tinyint>, scale double"
LEDGER = "ts string, engine string, book string, pages int, usd double, run_id string, note string"
TRANSLATION = "id string, unit_id string, en string, engine string, model string"
