"""Licence recognition by sentences and ordered rules, in DataFrame functions.

A text is normalised line by line and cut into sentences; a known licence sentence begins and ends where a line or a sentence
does and may go over line ends, but not over blank lines.  Each is mapped to its identifier; the sequence of
identifiers is matched against rules, each a licence's sentences in order, other known sentences between them allowed.
Everything happens inside the row: no shuffle, no join, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known licence sentences, normalised (lower case; runs of other than a-z, 0-9, '.', '+', '-' are one space; no '.' at the end).
SENTENCES = {
    "mit-ref": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "this software is released under the mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "apache2-ref": ["licensed under the apache license version 2.0", "licensed under the apache license version 2.0 the license", "released under the apache license version 2.0"],
    "apache2-comply": ["you may not use this file except in compliance with the license"],
    "apache2-obtain": ["you may obtain a copy of the license at"],
    "gpl2-ref": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"],
    "gpl3-ref": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"],
    "gpl-free": ["this program is free software"],
    "gpl2-later": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl3-later": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl-ref": ["licensed under the gnu lesser general public license version 2.1", "licensed under the gnu lesser general public license version 3"],
    "agpl3-ref": ["licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-names": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "mpl2-ref": ["this source code form is subject to the terms of the mozilla public license v. 2.0"],
    "cc-by-ref": ["licensed under cc by 4.0", "licensed under cc by 3.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "cc-by-sa-ref": ["licensed under cc by-sa 4.0", "licensed under cc by-sa 3.0", "this work is licensed under a creative commons attribution-sharealike 4.0 international license"],
    "cc-by-nc-ref": ["licensed under cc by-nc 4.0", "licensed under cc by-nc 3.0", "this work is licensed under a creative commons attribution-noncommercial 4.0 international license"],
    "cc-by-nc-nd-ref": ["licensed under cc by-nc-nd 4.0"],
    "cc0-ref": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "licensed under cc0 1.0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "reserved": ["all rights reserved"],
}

#: Fixed values: (licence, sentence identifiers in order).
RULES = [
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-ref"]),
    ("Apache-2.0", ["apache2-ref"]),
    ("Apache-2.0", ["apache2-comply", "apache2-obtain"]),
    ("GPL-2.0-only", ["gpl2-ref"]),
    ("GPL-3.0-only", ["gpl3-ref"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-later"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("LGPL", ["lgpl-ref"]),
    ("AGPL-3.0-only", ["agpl3-ref"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MPL-2.0", ["mpl2-ref"]),
    ("CC-BY", ["cc-by-ref"]),
    ("CC-BY-SA", ["cc-by-sa-ref"]),
    ("CC-BY-NC", ["cc-by-nc-ref"]),
    ("CC-BY-NC-ND", ["cc-by-nc-nd-ref"]),
    ("CC0-1.0", ["cc0-ref"]),
    ("Unlicense", ["unlicense"]),
    ("all-rights-reserved", ["reserved"]),
]

KNOWN = {text: name for name, texts in SENTENCES.items() for text in texts}
#: A rule that another one of the same start contains gives way to it.
_SHORTER = {"BSD-2-Clause": "BSD-3-Clause"}


def _pattern(names: list[str]) -> str:
    return " " + r" (?:[^ ]+ )*?".join(names) + " "


#: Every known sentence has one of these.
_WORDS = "licen|permission|copyright|warrant|redistribut|software|domain|rights"


def lines(text: Column) -> Column:
    """One normalised line for each line and for what follows . ; : ! ? before white space; marks of comments go."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"([.;:!?])[ \t\x0B\f\r]+\n?", "$1\n")
    t = F.regexp_replace(t, r"[^a-z0-9.+\n-]+", " ")
    return F.regexp_replace(t, r"(?dm)^[ .-]*+(?:(?:rem|dnl) [ .-]*+)?|(?<![ .-])[ .-]++$", "")


def _sentence(text: str) -> str:
    return text.replace(".", r"\.").replace("+", r"\+").replace(r"\. ", r"\.? ").replace(" ", "[ \n]")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_known, sentence_ids, licences for each row of ``docs``.

    sentence_ids: the known sentences of the whole text in order, by spaces; licences: the rules that match, in the order of
    RULES, by '|'; both empty where there are none, and for null or empty texts.  Repeated rows each have a row.
    """
    text = F.col(text_col).cast("string")
    known = F.create_map(*[F.lit(x) for text, name in KNOWN.items() for x in (text.replace(". ", " "), name)])
    any_of = "(?dm)^(?:" + "|".join(map(_sentence, sorted(KNOWN, key=len, reverse=True))) + ")$"
    pieces = F.when(F.lower(text).rlike(_WORDS), F.regexp_extract_all(lines(text), F.lit(any_of), F.lit(0))).otherwise(F.array().cast("array<string>"))
    ids = F.transform(pieces, lambda s: F.element_at(known, F.regexp_replace(F.translate(s, "\n", " "), r"\. ", " ")))
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), ids.alias("ids"))
    line = F.concat(F.lit(" "), F.array_join("ids", " "), F.lit(" "))
    hits = []
    for licence in dict.fromkeys(name for name, _ in RULES):
        test = F.lit(False)
        for name, rule in RULES:
            if name == licence:
                test = test | line.rlike(_pattern(rule))
        if licence in _SHORTER:
            longer = next(rule for name, rule in RULES if name == _SHORTER[licence])
            test = test & ~line.rlike(_pattern(longer))
        hits.append(F.when(test, F.lit(licence)))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_known"), F.array_join("ids", " ").alias("sentence_ids"), F.when(F.size("ids") == 0, F.lit("")).otherwise(F.concat_ws("|", *hits)).alias("licences"))


def oracle() -> str:
    """The same for DuckDB."""
    known = ", ".join(f"'{text}': '{name}'" for text, name in KNOWN.items())
    cases = []
    for licence in dict.fromkeys(name for name, _ in RULES):
        test = " OR ".join(f"regexp_matches(line, '{_pattern(rule)}')" for name, rule in RULES if name == licence)
        if licence in _SHORTER:
            longer = next(rule for name, rule in RULES if name == _SHORTER[licence])
            test = f"({test}) AND NOT regexp_matches(line, '{_pattern(longer)}')"
        cases.append(f"CASE WHEN {test} THEN '{licence}' END")
    return f"""
        WITH known AS (SELECT unnest(map_entries(MAP {{{known}}}), recursive := true)),
        cut AS (SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '([.;:!?])[ \\t\\x0B\\f\\r]+', '\\1' || chr(10), 'g'), chr(10))) AS s,
                       generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '([.;:!?])[ \\t\\x0B\\f\\r]+', '\\1' || chr(10), 'g'), chr(10)), 1) AS pos FROM documents),
        hit AS (SELECT doc_id, pos, k.value AS id FROM cut JOIN known k ON k.key = regexp_replace(regexp_replace(lower(s), '[^a-z0-9.+-]+', ' ', 'g'), '^[ .-]+|[ .-]+$', '', 'g')),
        seq AS (SELECT doc_id, count(*) AS n_known, string_agg(id, ' ' ORDER BY pos) AS sentence_ids FROM hit GROUP BY doc_id),
        lined AS (SELECT *, ' ' || sentence_ids || ' ' AS line FROM seq)
        SELECT d.doc_id, coalesce(l.n_known, 0) AS n_known, coalesce(l.sentence_ids, '') AS sentence_ids,
               CASE WHEN l.doc_id IS NULL THEN '' ELSE concat_ws('|', {", ".join(cases)}) END AS licences
        FROM documents d LEFT JOIN lined l ON l.doc_id = d.doc_id"""
