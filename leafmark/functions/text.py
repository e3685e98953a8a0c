"""Text functions as Column -> Column expressions; they stay in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values ------------------------------------------------------------------------------------------------------------
#: Zero-width and soft characters that carry no reading.
DROPPED = "​‌‍­﻿"
#: Quotation glyphs and what they count as.
QUOTES_FROM, QUOTES_TO = "‘’`´“”′″", "''''\"\"'\""
#: Gurmukhi carrier + sign, and the independent vowel it stands for.
CARRIERS = {
    "ੳੁ": "ਉ", "ੳੂ": "ਊ", "ੳੋ": "ਓ",
    "ਅਾ": "ਆ", "ਅੈ": "ਐ", "ਅੌ": "ਔ",
    "ੲਿ": "ਇ", "ੲੀ": "ਈ", "ੲੇ": "ਏ",
}
CONSONANT, NUKTA, VOWEL_SIGNS = "ਕ-ਹਖ਼-ਫ਼", "਼", "ਾ-ੌ"
COMBINING = "ਁਂਃ਼ਾ-੍ੰੱੵ"
#: Gurmukhi letters that NFC takes apart.
NFC = {"ਲ਼": "ਲ਼", "ਸ਼": "ਸ਼", "ਖ਼": "ਖ਼", "ਗ਼": "ਗ਼", "ਜ਼": "ਜ਼", "ਫ਼": "ਫ਼"}
PUNCTUATION = ".,;:!?\"'()[]{}।॥|-–—‘’“”"
STOP_WORDS = (
    "the a an of is are was were to in and or for with by that this his her its it he she they we you i as be been on at from "
    "not but so all no nor own do does did have has had will would shall should may might can could am me my your their our them "
    "us who whom which what when where why how than then there here such very just only also even if"
).split()
ANG_RANGE = (2, 1430)
_SGGS = r"(?i)\(\s*[^()]{0,60}?SGGS\s*,?\s*(?:pp?|pg|page|ang)?\.?\s*([0-9]{1,4})(?:\s*-\s*[0-9]{1,4})?\s*\)|\bSGGS\s*,?\s*(?:pp?|pg|page|ang)?\.?\s*([0-9]{1,4})"
_PG = r"(?i)\[\s*(?:Pg|Page|Ang|P)\.?\s*([0-9]{1,4})\s*(?:-\s*[0-9]{1,4}\s*)?\]"
_PAREN = r"^(.*?\(\s*)([0-9]{2,4})(\s*(?:-\s*[0-9]{2,4}\s*)?\)\s*[^0-9]{0,24})$"
_TRAILING = r"^(|.*?[^0-9])([0-9]{2,4})(\s*(?:-\s*[0-9]{2,4})?\s*[^0-9]{0,24})$"
COUNTER = r"(?i)\|\|\s*[0-9]*\s*\|\||\|\|\s*Pause\s*\|\||\bPause\b\s*\|\||\.\s*Pause\s*\."
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
SENTENCE_END = r"(?<=[।॥.?!])\s+"
STAMP = r"(?i)^\s*(page\s+\d+(\s+of\s+\d+)?|www\.\S+|\S*sikhbookclub\S*)\s*$"
STAMP_WORD = r"(?i)sikhbookclub|^page\s+\d+"
STAMP_ANY = r"(?i)\bpage\s+\d+\s+of\s+\d+\b"
PAGES_WORD = "ਪੰਨਾ"
DIGITS = "0-9੦-੯"
PAGE_NUMBER = rf"^[\s(){DIGITS}।]+$"
FOOTNOTE_START = rf"^[{DIGITS}]{{1,2}}[.)]?\s"
STANZA_END = r"॥\s*[੦-੯]+(?:\s*॥\s*[੦-੯]+)*\s*॥\s*$"
TITLE_LINE = r"^\s*[੦-੯0-9]+\s*[:.]\s*\S"
FOOTNOTE_MARK = rf"^(.{{2,}}?[^{DIGITS}])([{DIGITS}]{{1,2}})$"
# -------------------------------------------------------------------------------------------------------------------------


def _class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "\\[]^-&" else c for c in chars) + "]"


def squeezed(c: Column) -> Column:
    """White space runs are one space; none outside."""
    return F.trim(F.regexp_replace(c, r"[ \t\n\x0B\f\r]+", " "))


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalise(c: Column, nfc: bool = True) -> Column:
    """The comparable form of a line; idempotent.  NFC is exact for Gurmukhi and a no-op for text that is composed already.

    Rules for one script run only on texts that have it.
    """
    plain = F.translate(F.translate(F.coalesce(c, F.lit("")), DROPPED, ""), QUOTES_FROM, QUOTES_TO)
    out = plain
    if nfc:
        for a, b in NFC.items():
            out = F.replace(out, F.lit(a), F.lit(b))
    for a, b in CARRIERS.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.regexp_replace(out, f"(?<![{CONSONANT}{VOWEL_SIGNS}{NUKTA}])ਿ([{CONSONANT}]{NUKTA}?)", "$1ਿ")
    out = F.regexp_replace(out, f"([{COMBINING}])\\1+", "$1")
    return squeezed(F.when(plain.rlike("[਀-੿]"), out).otherwise(plain))


def graphemes(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(?s)\X"), F.lit(0))


def characters(c: Column) -> Column:
    """Code points, one a piece."""
    return F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))


def script_of(c: Column) -> Column:
    g, d, latin = c.rlike("[਀-੿]"), c.rlike("[ऀ-ॿ]"), c.rlike("[A-Za-z]")
    n = g.cast("int") + d.cast("int") + latin.cast("int")
    return F.when(n == 0, "none").when(n > 1, "mixed").when(g, "gurmukhi").when(d, "devanagari").otherwise("latin")


def words(c: Column) -> Column:
    """Tokens of the normalised text without punctuation around them: from the first to the last character that is none."""
    inner = "[^ " + _class(PUNCTUATION)[1:]
    return F.regexp_extract_all(normalise(c), F.lit(f"{inner}(?:[^ ]*{inner})?"), F.lit(0))


def footnote_marker(word: Column) -> Column:
    """struct(word, marker): a one- or two-digit tail glued to a word of letters; marker null where there is none."""
    head, tail = F.regexp_extract(word, FOOTNOTE_MARK, 1), F.regexp_extract(word, FOOTNOTE_MARK, 2)
    good = (tail != "") & head.rlike("[A-Za-z਀-੿]")
    return F.struct(F.when(good, head).otherwise(word).alias("word"), F.when(good, tail).alias("marker"))


def is_stanza_end(c: Column) -> Column:
    """Whether a verse line ends with its stanza's number."""
    return F.coalesce(c, F.lit("")).rlike(STANZA_END)


def sentences(c: Column) -> Column:
    return F.filter(F.split(squeezed(c), SENTENCE_END), lambda s: s != "")


def content_tokens(c: Column) -> Column:
    """Distinct words of a-z0-9 over two letters that are not stop words."""
    found = F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_except(F.filter(found, lambda w: F.length(w) > 2), F.array(*[F.lit(w) for w in STOP_WORDS]))


def _in_range(n: Column) -> Column:
    return n.between(*ANG_RANGE)


def found_ang(c: Column) -> Column:
    """struct(ang, rest): the page a quotation cites and the text without the citation; ang null where none is cited."""

    def number(pattern: str, group: int) -> Column:
        return F.when(may[pattern], F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).cast("int"))

    # what a text must have for a rule to match; far cheaper than the rule
    may = {_SGGS: F.contains(F.lower(c), F.lit("sggs")), _PG: F.contains(c, F.lit("[")) & F.contains(c, F.lit("]"))}
    may |= {"(?s)" + _PAREN: F.contains(c, F.lit("(")) & F.contains(c, F.lit(")")), "(?s)" + _TRAILING: c.rlike("[0-9]{2}")}
    sggs = F.coalesce(number(_SGGS, 1), number(_SGGS, 2))
    start = F.regexp_instr(c, F.lit(_SGGS))
    length = F.length(F.regexp_substr(c, F.lit(_SGGS)))
    without = trimmed(F.concat(F.substring(c, F.lit(1), start - 1), F.lit(" "), F.substring(c, start + length, F.length(c))))
    pg = number(_PG, 1)
    rules = [(sggs, without), (pg, trimmed(F.regexp_replace(c, _PG, " ")))]
    for pattern in (_PAREN, _TRAILING):
        pattern = "(?s)" + pattern
        rest = F.concat(F.regexp_extract(c, pattern, 1), F.lit(" "), F.regexp_extract(c, pattern, 3))
        rules.append((number(pattern, 2), trimmed(rest)))
    ang, rest = F.lit(None).cast("int"), c
    for n, text in reversed(rules):
        good = F.coalesce(_in_range(n), F.lit(False))
        ang, rest = F.when(good, n).otherwise(ang), F.when(good, text).otherwise(rest)
    return F.struct(ang.alias("ang"), rest.alias("rest"))


def clean_quote(c: Column) -> Column:
    out = F.regexp_replace(found_ang(c)["rest"], COUNTER, " ")
    out = F.regexp_replace(out, r"^\s*[0-9]{1,3}\s*[.)]?\s+", "")
    return F.regexp_replace(F.regexp_replace(out, r"\s+", " "), "^[ .–—-]+|[ .–—-]+$", "")


def looks_quoted(c: Column) -> Column:
    return c.rlike(_PG) | c.rlike(_SGGS) | c.rlike(COUNTER) | F.coalesce(found_ang(c)["ang"] > 61, F.lit(False))


def wholly(c: Column) -> Column:
    body = trimmed(found_ang(c)["rest"])
    return body.rlike('^["“]') & body.rlike('["”]\\s*[.)]?\\s*$')


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def is_stamp(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    return c.rlike(STAMP) | c.rlike(STAMP_WORD) | ((F.length(c) < 40) & c.rlike(STAMP_ANY))


def to_number(c: Column) -> Column:
    """ASCII or Gurmukhi digits as an int."""
    digits = F.regexp_replace(F.translate(c, "੦੧੨੩੪੫੬੭੮੯", "0123456789"), "[^0-9]", "")
    return F.nullif(digits, F.lit("")).cast("int")


def header_hints(c: Column, pages_word: str = PAGES_WORD) -> Column:
    """struct(ang_from, ang_to, book_page, section) of a running header; null where it does not say."""
    c = F.coalesce(c, F.lit(""))
    span = rf"{pages_word}\s*([{DIGITS}]+)\s*(?:[-\u2013\u2014]\s*([{DIGITS}]+))?"
    lo, hi = to_number(F.regexp_extract(c, span, 1)), to_number(F.regexp_extract(c, span, 2))
    hi = F.when(F.coalesce(hi, lo) < lo, lo).otherwise(F.coalesce(hi, lo))
    page = to_number(F.regexp_extract(c, rf"\(\s*([{DIGITS}]+)\s*\)", 1))
    tail = to_number(F.regexp_extract(c, rf"([{DIGITS}]+)\s*$", 1))
    head = F.regexp_replace(F.split(c, r"\(")[0], "^[ :–-]+|[ :–-]+$", "")
    return F.struct(lo.alias("ang_from"), hi.alias("ang_to"), F.coalesce(page, F.when(lo.isNull(), tail)).alias("book_page"), F.when((head != "") & ~head.rlike(PAGE_NUMBER), head).alias("section"))


def unligatured(c: Column) -> Column:
    for a, b in LIGATURES.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def without_thinking(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<think>.*?</think>\s*", "")


def plain_html(c: Column) -> Column:
    """Line breaks of br, no tags, three entities."""
    out = F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", "")
    return F.replace(F.replace(F.replace(out, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda's variable is bound, an expression in a lambda is run each time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeats(c: Column, window: int = 6, times: int = 3) -> Column:
    """Whether some run of ``window`` words, lower-cased, occurs ``times`` times or more."""
    w = F.filter(F.split(F.lower(c), r"\s+"), lambda x: x != "")

    def grams(words: Column) -> Column:
        return F.array_sort(F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.array_join(F.slice(words, i, window), " ")))

    def again(g: Column) -> Column:  # sorted: equal grams lie side by side
        return F.exists(F.sequence(F.lit(0), F.size(g) - times), lambda i: F.get(g, i) == F.get(g, i + times - 1))

    found = let(w, lambda words: F.when(F.size(words) >= window + times - 1, let(grams(words), again)))
    return F.coalesce(found, F.lit(False))


def translation_fault(src: Column, out: Column, source_script: str = "[਀-੿]") -> Column:
    """The first reason to reject a translation, or null."""
    t = F.coalesce(out, F.lit(""))
    return (
        F.when(trimmed(t) == "", "empty")
        .when(t.rlike(source_script), "source script")
        .when(~t.rlike("[A-Za-z]"), "no latin")
        .when(F.length(t) > 4 * F.length(F.coalesce(src, F.lit(""))) + 40, "too long")
        .when(repeats(t), "repeats")
    )


def levenshtein_items(a: Column, b: Column) -> Column:
    """Edit distance of two arrays of strings: each distinct item becomes one private-use character, then Spark's levenshtein."""

    def coded(x: Column, book: Column) -> Column:
        return F.array_join(F.transform(x, lambda i: F.decode(F.unhex(F.hex(F.array_position(book, i) + F.lit(0xE000 - 1))), "UTF-16BE")), "")

    plain_a, plain_b = F.array_join(a, ""), F.array_join(b, "")
    single = (F.length(plain_a) == F.size(a)) & (F.length(plain_b) == F.size(b))  # every item is one character already
    # a band is enough for texts that differ little
    banded = let(F.levenshtein(plain_a, plain_b, 256), lambda d: F.when(d >= 0, d).otherwise(F.levenshtein(plain_a, plain_b)))
    return F.when(single, F.when(plain_a == plain_b, 0).otherwise(banded)).otherwise(let(F.array_distinct(F.concat(a, b)), lambda book: F.levenshtein(coded(a, book), coded(b, book))))


def error_rate(ref: Column, hyp: Column) -> Column:
    """Edits over reference items; an empty reference gives 0 or 1."""
    return F.when(F.size(ref) == 0, F.when(F.size(hyp) == 0, 0.0).otherwise(1.0)).otherwise(levenshtein_items(ref, hyp) / F.size(ref))
