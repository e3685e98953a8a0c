"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of one host.

A page is a stream of block tags and texts (inline tags belong to the text around them; end tags that HTML implies are put in).
Pages of a host are aligned one after another with what the host's wrapper is so far.  Where streams differ, the wrapper is
generalised without unions: differing strings become a text slot; a tag run that repeats becomes a repeated group; what only
one side has becomes optional.  Each slot gathers how often it was filled, its characters and its link characters.
When a host's wrapper is complete, its slots are labelled once, main text or not, and each page is read through them.

Tasks merge their own pages first and send one wrapper a host, so a host with a third of all pages costs a task-sized merge;
wrappers are broadcast while their measured size is small, and joined by host with salt beyond that.
"""

from __future__ import annotations

import html
import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch

#: Wrappers of all hosts together are broadcast up to this many bytes.
BROADCAST = 32 << 20
_SALTS = 32
#: Groups of tasks whose wrappers of a host are merged before they meet.
_FAN = 256
#: Hosts that a task holds before it sends what it has.
_HOSTS = 2000

# Elements whose content is no text, elements that flow inside a text, elements without content.
_HIDDEN = {"script", "style", "noscript", "template", "svg", "head", "title", "iframe", "object", "canvas", "audio", "video", "textarea", "select", "option", "button", "datalist", "annotation", "annotation-xml"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "nobr", "output", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "math", "semantics", "mi", "mn", "mo", "ms", "mrow", "mtext", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder", "munderover", "mtable", "mtr", "mtd", "mstyle", "mspace"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe"}
_END_OF = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in _RAW}
#: What a head may hold; what ends an option or button that was left open.
_IN_HEAD = {"head", "title", "meta", "link", "base", "script", "style", "noscript", "template", "object"}
_NEXT_OF = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])", re.I) for tag in ("option", "button")}
_AROUND_CONTROLS = {"form", "div", "p", "section", "article", "main", "body", "html", "nav", "header", "footer", "aside", "li", "ul", "td", "fieldset"}
_FLOW = {"article", "main", "section", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "table", "blockquote", "pre", "form", "nav", "aside", "header", "footer"}
#: An element that is open is ended by the start of one of these.
_ENDED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "th": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "option": {"option"}}
_AROUND = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset", "address"}
_MAIN = {"article", "main"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "dialog", "alert", "alertdialog"}
_NAMED = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notices?|notification|alert|sidebar|side|menu|nav\w*|breadcrumbs?|footer|masthead|header|comments?|commentlist|discussion|disqus|respond|replies|reply|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|search\w*|widget|popup|modal|overlay|copyright|skip|pagination|pager|toolbar|tags|byline-links)(?:$|[^a-z])")
#: Names that tell furniture even inside an article: whole words of a class or id, with what such words are joined to.
_HARD = re.compile(r"(?:^|[\s#.@])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|cookie-bar|consent|gdpr|nav\w*|menu|breadcrumbs?|sidebar|comments?|commentlist|disqus|respond|replies|share|sharing|social|newsletter|subscribe|signup|pagination|pager|toolbar|popup|modal|overlay|(?:related|recommended)(?:-(?:posts?|articles?|links?|stories|content|news|items?|reading))?)(?:[-_](?:box|block|bar|banner|section|list|area|container|wrapper|wrap|inner|widget|form|buttons?|links?|slot|unit|top|bottom|left|right))*(?=$|[\s#@])")
_BODY = re.compile(r"(?:^|[^a-z])(?:article|content|main|post|entry|story|maincontent|articlebody|bodytext)(?:$|[^a-z])")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^=>]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile(r"\d+")


class Item:
    """An element (key, children) or, with key None, a text.  ``many``: repeated; ``maybe``: optional.

    A text of a page has ``text``; a slot of a wrapper has its fixed string, or None once pages differed.
    """

    __slots__ = ("key", "children", "many", "maybe", "text", "pages", "chars", "links", "main")

    def __init__(self, key: str | None, text: str | None = None, chars: int = 0, links: int = 0):
        self.key, self.children, self.many, self.maybe = key, [], False, False
        self.text, self.pages, self.chars, self.links, self.main = text, 1, chars, links, True

    def __getstate__(self):
        return tuple(getattr(self, k) for k in self.__slots__)

    def __setstate__(self, state):
        for k, v in zip(self.__slots__, state, strict=True):
            setattr(self, k, v)


def _key(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    got = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    if not got:
        return tag
    return f"{tag}.{_DIGITS.sub('', got.get('class', '')).strip().lower()}#{_DIGITS.sub('', got.get('id', '')).strip().lower()}@{got.get('role', '').lower()}"


def parse(page: str | None) -> Item:
    """The page's blocks as a tree below one root; character references are decoded, white space is one space."""
    root = Item("")
    stack: list[tuple[str, Item]] = [("", root)]
    parts: list[str] = []
    link_chars, in_link, hidden = 0, 0, ""
    depth, loose = 0, False  # loose: open without an end tag of its own

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                stack[-1][1].children.append(Item(None, text, len(text), min(link_chars, len(text))))
            parts.clear()
        link_chars = 0

    page = page or ""
    at = 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if not hidden and not (piece[0] == "<" and len(piece) > 1):
                piece = html.unescape(piece)
                parts.append(piece)
                if in_link:
                    link_chars += len(piece.strip())
            continue
        tag, closing = tag.lower(), m[1] == "/"
        if not m[4]:  # the page ends inside the tag
            break
        if hidden == "head" and not closing and tag not in _IN_HEAD or loose and (tag in _AROUND_CONTROLS if closing else tag in _FLOW):
            hidden, loose = "", False  # its end tag was left out
        if not closing and tag in _RAW and not m[3].endswith("/"):  # no markup inside: on to its own end tag
            end = _END_OF[tag].search(page, at)
            if end is None:
                if tag != "noscript":
                    break
            else:
                at = end.end()
            continue
        if hidden:
            if tag == hidden:
                depth += -1 if closing else 1
                if depth <= 0 or loose:
                    hidden, loose, depth = ("", False, 0) if closing else (tag, loose, 1)
                if not closing and loose:
                    end = _NEXT_OF[tag].search(page, at)
                    loose = end is None or not end[1]
            continue
        if tag in _VOID:
            if tag == "br":
                parts.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in _HIDDEN:
            if not closing and not m[3].endswith("/"):
                hidden, depth = tag, 1
                end = _NEXT_OF[tag].search(page, at) if tag in _NEXT_OF else None
                loose = tag in _NEXT_OF and (end is None or not end[1])
            continue
        if tag in _INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if stack[-1][0] == "p":
            stack.pop()
        ended = next((i for i in range(len(stack) - 1, max(0, len(stack) - 4), -1) if tag in _ENDED.get(stack[i][0], ())), 0)
        if ended:
            del stack[ended:]
        item = Item(_key(tag, m[3]))
        stack[-1][1].children.append(item)
        stack.append((tag, item))
    if not hidden:
        flush()
    return root


# -- inference ------------------------------------------------------------------------------------------------------------
def _joined(a: Item, b: Item, same_page: bool) -> Item:
    """Generalises ``a`` so that it covers ``b`` too; both have one key."""
    if a.key is None:
        if a.text != b.text:
            a.text = None  # string mismatch: a text slot
    else:
        a.children = _aligned(a.children, b.children, same_page)
    a.many, a.maybe = a.many or b.many or same_page, a.maybe or b.maybe
    a.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    a.chars, a.links = a.chars + b.chars, a.links + b.links
    return a


def folded(items: list[Item]) -> list[Item]:
    """Tag mismatches that are repetitions: neighbouring runs of one to three elements with equal keys become repeated groups."""
    out: list[Item] = []
    for item in items:
        if item.key is not None:
            item.children = folded(item.children)
        out.append(item)
        for size in (1, 2, 3):
            left, right = out[-2 * size : -size], out[-size:]
            if len(left) == size and [x.key for x in left] == [x.key for x in right] and (size > 1 or right[0].key is not None) and any(x.key is not None for x in left):
                del out[-size:]
                for x, y in zip(left, right, strict=True):
                    _joined(x, y, True)
                break
    return out


def _aligned(a: list[Item], b: list[Item], same_page: bool) -> list[Item]:
    """Merges two lists along a longest common subsequence of keys; what one side lacks becomes optional."""
    if [x.key for x in a] == [x.key for x in b]:
        return [_joined(x, y, same_page) for x, y in zip(a, b, strict=True)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, key = best[i], best[i + 1], a[i].key
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if key == b[j].key else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i].key == b[j].key and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(_joined(a[i], b[j], same_page))
            i, j = i + 1, j + 1
            continue
        if j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            x, i = a[i], i + 1
        else:
            x, j = b[j], j + 1
        x.maybe = True
        out.append(x)
    return folded(out)


def wrapper_of(page: Item) -> Item:
    page.children = folded(page.children)
    return page


def merged(a: Item, b: Item) -> Item:
    return _joined(a, b, False)


# -- labels ---------------------------------------------------------------------------------------------------------------
def _around(key: str, named: bool = True) -> bool:
    """Whether an element is furniture by its tag or role, or, with ``named``, by its class or id."""
    tag, _, rest = key.partition(".")
    if tag in _AROUND:
        return True
    if not rest or tag in ("body", "html"):
        return False
    names, _, role = rest.partition("@")
    return role in _ROLES or named and bool(_NAMED.search(names)) and tag not in _MAIN


#: Pages of a host that must agree on a string before it counts as the template's.
FIXED = 5
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def labelled(wrapper: Item) -> Item:
    """Sets ``main`` on every text slot, bit k for reading at level k, and the host's level on the root: inside article or main
    (else a container named for content, else anywhere), outside menus, headers, footers, sidebars, notices, adverts, forms and
    comments.

    How a slot behaves over the host's pages comes first: a string fixed over FIXED pages or more where other slots vary is the
    template's, wherever it stands (headings inside an article excepted).  Names come second, and inside an article only hard
    ones, or soft ones (alert, notice, header ...) on fixed strings.  Without a container, slots that are mostly links go too.
    """
    slots: list[tuple[Item, bool, int, bool]] = []

    def walk(item: Item, by_tag: bool, by_name: bool, soft: bool, inside: int, names: bool, heading: bool) -> None:
        for x in item.children:
            if x.key is None:
                slots.append((x, by_tag or by_name or soft and x.text is not None and x.pages >= 3, inside, heading))
                continue
            tag, _, rest = x.key.partition(".")
            main = tag in _MAIN or rest.endswith("@main") or rest.endswith("@article")
            body = bool(rest) and bool(_BODY.search(rest.partition("@")[0]))
            around = by_tag or _around(x.key, False) and not (inside == 2 and tag == "address")
            named = names and bool(rest) and tag not in _MAIN and tag not in ("body", "html") and bool(_NAMED.search(rest.partition("@")[0]))
            hard = named and (inside < 2 or bool(_HARD.search(rest.partition("@")[0])))
            # what wraps a whole article may be named after what it lacks ("no-sidebar")
            walk(x, around, False if main else by_name or hard, False if main else soft or named and not hard, max(inside, 2 if main else 1 if body else 0), names, heading or tag in _HEADINGS)

    walk(wrapper, False, False, False, 0, True, False)
    if slots and all(around for _, around, _, _ in slots):  # names leave nothing: tags alone decide
        slots.clear()
        walk(wrapper, False, False, False, 0, False, False)
    mass = [sum(x.chars for x, around, k, _ in slots if not around and k >= level) for level in (0, 1, 2)]
    level = 2 if mass[2] > 0 else 1 if mass[1] >= 0.5 * mass[0] > 0 else 0
    varied = [any(x.text is None for x, around, k, _ in slots if not around and k >= at) for at in (0, 1, 2)]
    for x, around, k, heading in slots:
        fixed = x.text is not None and x.pages >= FIXED
        fits = [at for at in range(k + 1) if not (fixed and varied[at] and not (at and heading))]
        x.main = 0 if around else sum(1 << at for at in fits if at or x.links <= 0.5 * x.chars)
    wrapper.main = level
    return wrapper


def read_through(page: Item, wrapper: Item) -> list[str]:
    """The page's blocks in main slots, in order; an item the wrapper lacks has the label of its neighbours' parent.

    A page that fills no slot of the host's level, as those of a host's other template, is read at the next lower level.
    """
    for level in range(int(wrapper.main), -1, -1):
        if out := _read_at(page, wrapper, level):
            return out
    return []


def _read_at(page: Item, wrapper: Item, level: int) -> list[str]:
    out: list[str] = []
    filled = False

    def walk(items: list[Item], slots: list[Item], main: bool, inside: bool) -> None:
        nonlocal filled
        at = 0
        for x in items:
            found = next((j for j in range(at, len(slots)) if slots[j].key == x.key), None)
            if found is None:
                found = next((j for j in range(at) if slots[j].key == x.key), None)
            slot = slots[found] if found is not None else None
            if slot is not None:
                at = found
            if x.key is None:
                if slot.main >> level & 1 if slot is not None else main:
                    out.append(x.text)
                    filled = filled or slot is not None
                if slot is not None and not slot.many:
                    at = found + 1
            else:
                inner = inside or x.key.partition(".")[0] in _MAIN
                tag, _, rest = x.key.partition(".")
                open_ = tag == "address" or not (_around(x.key, False) or rest and _HARD.search(rest.partition("@")[0])) if inside else not _around(x.key)
                walk(x.children, slot.children if slot is not None else [], main and bool(open_), inner)
                if slot is not None and not slot.many:
                    at = found + 1

    walk(page.children, wrapper.children, True, False)
    return out if filled or not level else []


# -- tables ---------------------------------------------------------------------------------------------------------------
def host_of(url):
    """The host of a URL, lower-cased; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1), F.lit("")))


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Item] = {}

    def sent() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([pickle.dumps(x) for x in held.values()], pa.binary())], ["host", "wrapper"])
        held.clear()
        return rows

    for batch in batches:
        for host, page in zip(batch.column(0), batch.column(1), strict=True):
            host = host.as_py()
            if host:
                tree = wrapper_of(parse(page.as_py()))
                held[host] = merged(held[host], tree) if host in held else tree
        if len(held) >= _HOSTS:
            yield sent()
    if held:
        yield sent()


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (labelled, pickled) from pages of (host, html)."""

    def fold(rows):
        import pandas as pd

        own = None
        for blob in sorted(rows["wrapper"]):  # the same order whatever arrives first
            own = pickle.loads(blob) if own is None else merged(own, pickle.loads(blob))
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [pickle.dumps(own)]})

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [pickle.dumps(labelled(pickle.loads(blob))) for blob in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.binary())], ["host", "wrapper"])

    # a tree of merges: tasks, then groups of tasks, then hosts, so no host brings all its tasks to one
    schema = "host string, wrapper binary"
    partial = pages.select("host", "html").mapInArrow(_infer, schema).withColumn("salt", F.spark_partition_id() % _FAN)
    some = partial.groupBy("host", "salt").applyInPandas(fold, schema)
    return some.groupBy("host").applyInPandas(fold, schema).mapInArrow(label, schema)


def _text(page: str | None, wrapper: Item | None) -> str:
    tree = parse(page)
    return "\n\n".join(read_through(tree, wrapper or labelled(wrapper_of(parse(page)))))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages`` (page_id, url, html).

    Null or empty html gives an empty text.  A page without a host, or alone on it, is its own wrapper.  Repeated rows each
    have a row.  Markup that is cut off at the page's end is dropped; everything else of the main text stays.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    own = scratch.written(wrappers(rows), "wrappers")
    size = own.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    schema = "page_id long, url string, text string, n_chars long"

    if size <= BROADCAST:
        shared = spark.sparkContext.broadcast({r.host: bytes(r.wrapper) for r in own.collect()})
        rows = rows.withColumn("wrapper", F.lit(None).cast("binary"))
    else:  # by host, each host's wrapper once for each salt
        shared = spark.sparkContext.broadcast({})
        salted = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    rows = rows.select("page_id", "url", "html", "host", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, Item] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = []
                for page, host, blob in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                    if host not in ready and (blob := blob or shared.value.get(host)):
                        if len(ready) >= _HOSTS:
                            ready.clear()
                        ready[host] = pickle.loads(blob)
                    texts.append(_text(page, ready.get(host)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)
