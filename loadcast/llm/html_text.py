"""Main text of web pages: markup decides where it is declared, the host suffix
array decides the rest.

Every page is cut into text blocks. A block lies in declared chrome (menus,
headers, footers, sidebars, adverts, forms, notices, comments -- by element,
role, class or id), in the declared main part (article, main), or in neither.

Host suffix array: the word streams of all pages of a host, without the declared
main part, are one long text; its suffixes with a common prefix of at least
``RUN`` words on two distinct pages are boilerplate. One host may hold a third
of all pages, so the array is not sorted in one task: the intervals of depth
``RUN`` are groups of (host, hash of ``RUN`` words), and whether two pages are in
one is told by the smallest and the largest page key, which combine before the
shuffle. The union of these intervals covers exactly the words that a full array
would. Covered words of blocks that no markup declares are removed; every run
that stays is kept.

The method alone gives wrong results in two ways that pages really show: menus
and adverts that differ from page to page are unique and would stay, and articles
that a host has twice are repeated and would go. So a page that declares its main
part keeps all of it and nothing else, and declared chrome never stays. A class or id
declares less than an element: an article or main part within a wrapper that is
only marked so, or an article so marked, is the main part where the page has no
other. A mark is a whole class or id, all of whose words are marks or say where
or what a box is ("cookie-notice", "page-sidebar"; not "has-sidebar").

Text: character references are decoded; white space within a block becomes one
space; blocks are trimmed and joined in page order by one line feed.

Nulls and odd input: null or empty html gives an empty text; a url without a
host counts under the empty host; unclosed and stray tags are closed by the
enclosing element; an unfinished tag or comment at the end is dropped; rows that
are equal in id, url and html count as one page for repetition, and each gets
its row; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import cut, prepare, table
from loadcast.llm.textnp import shingles, span_hashes, text_buffer, words

RUN = 8
BROADCAST_PAGES = 200_000

# Elements and words that mark parts of a page.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "object", "canvas", "math", "textarea", "title", "audio", "video", "map"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "label", "fieldset", "input", "head"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
MARKS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
         "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar",
         "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promotion", "related", "respond", "search",
         "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
# words that a class may have beside a mark
PLACES = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "card", "container", "content", "form", "global", "group", "icons",
          "inner", "item", "items", "left", "links", "list", "main", "message", "mobile", "module", "outer", "page", "panel", "post", "posts",
          "primary", "reply", "right", "row", "secondary", "section", "side", "site", "slot", "sticky", "thread", "title", "top", "unit",
          "wrap", "wrapper"}
READERS = {"comment", "comments", "disqus", "respond"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*)(?:>|\Z)", re.S)
ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
SPLIT = re.compile(r"[-_]+")
# Parts of a page; within SOFT chrome an article opens a SOFT_MAIN part.
NEITHER, IN_CHROME, IN_MAIN, SOFT, SOFT_MAIN = range(5)
CLOSED_BY_OWN = {"p", "li", "tr", "td", "th", "dt", "dd", "option"}
PASSED = INLINE | {"p", "td", "th", "dt", "dd"}


def _marks(attributes: str) -> tuple[bool, bool, bool]:
    """Whether a role declares chrome, whether a class or id does, and whether that
    one is of reader comments."""
    role = marked = readers = False
    for name, a, b, c in ATTR.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() == "role":
            role |= value.strip() in ROLES
            continue
        for token in value.split():
            parts = {x for x in SPLIT.split(token) if x}
            if not MARKS.isdisjoint(parts) and parts <= MARKS | PLACES:
                marked = True
                readers |= not READERS.isdisjoint(parts)
    return role, marked, readers


class _Open:
    """Open elements with the part within each, found by name."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.barriers: list[int] = []  # places of elements that end a search for p, li, ...

    def push(self, name: str, part: int) -> None:
        if name not in PASSED:
            self.barriers.append(len(self.stack))
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, part))

    def last(self, name: str) -> int:
        at = self.places.get(name)
        return at[-1] if at else -1

    def last_in_reach(self, name: str) -> int:
        """The last one of its name that no other block is open within."""
        i = self.last(name)
        return i if not self.barriers or i >= self.barriers[-1] else -1

    def cut(self, i: int) -> None:
        """Close the elements from place ``i`` on."""
        while len(self.stack) > i:
            name, _ = self.stack.pop()
            self.places[name].pop()
            if self.barriers and self.barriers[-1] == len(self.stack):
                self.barriers.pop()

    def block_from(self, i: int) -> bool:
        """Whether a block element is open at place ``i`` or within it."""
        return (bool(self.barriers) and self.barriers[-1] >= i) or any(self.last(n) >= i for n in PASSED - INLINE)

    @property
    def part(self) -> int:
        return self.stack[-1][1] if self.stack else NEITHER


def _part_within(name: str, attributes: str, part: int) -> int:
    """The part that a block element opens within another part."""
    if part == IN_CHROME:
        return part
    main = part in (IN_MAIN, SOFT_MAIN)
    role, marked, readers = _marks(attributes) if attributes and name not in ("html", "body", "main") else (False, False, False)
    if name in CHROME or role or (name == "header" and not main):
        return IN_CHROME
    if name in MAIN:
        if readers or (marked and main):
            return IN_CHROME
        return part if main else SOFT_MAIN if marked or part == SOFT else IN_MAIN
    if marked:
        return IN_CHROME if main else SOFT
    return part


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, part) of every non-empty block, in page order."""
    out: list[tuple[str, int]] = []
    opened = _Open()
    text: list[str] = []
    part, at, size = NEITHER, 0, len(page)
    # an inline element of chrome within a block: its place among the open ones and in the text
    inline, mark, outer = -1, 0, NEITHER

    def close():
        nonlocal mark
        if inline >= 0:
            del text[mark:]
            mark = 0
        if text:
            t = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if t:
                out.append((t, outer if inline >= 0 else part))

    def leave(i):
        """Close the elements from place ``i`` on."""
        nonlocal inline, part
        if 0 <= i <= inline:
            del text[mark:]
            inline, part = -1, outer
        if opened.block_from(i):
            close()
        opened.cut(i)
        part = opened.part

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:  # comment, doctype, processing instruction
            continue
        name = name.lower()
        if m.group(1):
            i = opened.last(name)
            if i >= 0:
                leave(i)  # unclosed elements within it end too
            elif name not in INLINE:
                close()
            continue
        attributes = m.group(3) or ""
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in INLINE:
            if attributes and name not in VOID and part not in (IN_CHROME, SOFT) and any(_marks(attributes)):
                inline, mark, outer = len(opened.stack), len(text), part
                opened.push(name, IN_CHROME)
                part = IN_CHROME
            elif name not in VOID and not attributes.rstrip().endswith("/"):
                opened.push(name, part)
            continue
        close()
        if name in VOID:
            continue
        if name in CLOSED_BY_OWN:
            i = opened.last_in_reach(name)
            if i >= 0:
                leave(i)
        part = _part_within(name, attributes, part)
        opened.push(name, part)
    close()
    soft = IN_CHROME if any(p == IN_MAIN for _, p in out) else IN_MAIN
    return [(t, {SOFT: IN_CHROME, SOFT_MAIN: soft}.get(p, p)) for t, p in out]


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _streams(found: list[tuple[str, int]]) -> tuple[pa.Array, np.ndarray, bool]:
    declared = any(p == IN_MAIN for _, p in found)
    rest = [(t, p) for t, p in found if p != IN_MAIN]
    return pa.array([t for t, _ in rest], pa.large_string()), np.array([p for _, p in rest], np.int64), declared


def stream_words(found: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
    """Of a page's stream outside its declared main part: window hashes, first
    words, word hashes, whether each word may be removed, declared or not."""
    text, part, declared = _streams(found)
    buf, off = text_buffer(text)
    s, e, block = words(buf, off)
    h = span_hashes(buf, s, e, lower=False)
    sh, at = shingles(h, np.zeros(len(h), np.int64), RUN)
    free = (part[block] == NEITHER) & (not declared) if len(block) else np.zeros(0, bool)
    return sh, at, h, free, declared


def keyed(pages: DataFrame) -> DataFrame:
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return page.withColumn("page_key", F.xxhash64("page_id", "url", "html"))


def host_windows(pages: DataFrame) -> DataFrame:
    """(host, window, page_key, pos, free): the host streams' windows of ``RUN``
    words; ``free`` if it holds a word that may be removed."""
    names = ["host", "window", "page_key", "pos", "free"]

    def run(batches):
        for batch in batches:
            cols: list[list[np.ndarray]] = [[] for _ in names[1:]]
            hosts: list[str] = []
            keys = np.asarray(batch.column("page_key"))
            for i, (u, h) in enumerate(zip(batch.column("url").to_pylist(), batch.column("html").to_pylist())):
                sh, at, _, free, _ = stream_words(blocks(h or ""))
                if not len(sh):
                    continue
                c = np.concatenate([[0], np.cumsum(free)])
                for col, v in zip(cols, (sh.view(np.int64), np.full(len(sh), keys[i]), at.astype(np.int32), c[at + RUN] > c[at])):
                    col.append(v)
                hosts += [host_of(u)] * len(sh)
            if hosts:
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string())] + [pa.array(np.concatenate(c)) for c in cols], names)

    return pages.mapInArrow(run, "host string, window long, page_key long, pos int, free boolean")


def boilerplate(pages: DataFrame) -> DataFrame:
    """(covered_key, covered): per page, the first words of windows that another
    page of the host has too and that hold a word that may be removed."""
    w = host_windows(pages)
    shared = w.groupBy("host", "window").agg(F.min("page_key").alias("low"), F.max("page_key").alias("high"),
                                             F.max("free").alias("any_free")).filter("low < high and any_free")
    return (w.filter("free").join(shared.select("host", "window"), ["host", "window"])
            .groupBy(F.col("page_key").alias("covered_key")).agg(F.collect_set("pos").alias("covered")))


def main_text(found: list[tuple[str, int]], covered: list[int] | None) -> str:
    """Text of the declared main part, or of what is free and not covered."""
    if any(p == IN_MAIN for _, p in found):
        return "\n".join(t for t, p in found if p == IN_MAIN)
    gone: set[int] = set()
    for x in covered or ():
        gone.update(range(x, x + RUN))
    out, at = [], 0
    for t, p in found:
        w = t.split(" ")
        # words as the stream counts them: other white space is part of a word
        n = len(w)
        here = [at + i in gone for i in range(n)]
        at += n
        if p != NEITHER:
            continue
        if not any(here):
            out.append(t)
            continue
        run: list[str] = []
        for word, g in [*zip(w, here), ("", True)]:
            if not g:
                run.append(word)
            else:
                if run:
                    out.append(" ".join(run))
                run = []
    return "\n".join(out)


def extract(pages: DataFrame, broadcast_pages: int = BROADCAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    prepare(pages.sparkSession)
    page = keyed(pages)
    cover = cut(boilerplate(page))
    # pages whose main part is not declared and that share text; sized before it is broadcast
    small = cover.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("covered")), F.lit(0)).alias("words")).first()
    if small["n"] <= broadcast_pages and small["words"] <= 20 * broadcast_pages:
        cover = F.broadcast(cover)

    def run(batches):
        for batch in batches:
            text = [main_text(blocks(h or ""), c) for h, c in zip(batch.column("html").to_pylist(), batch.column("covered").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = page.join(cover, page["page_key"] == cover["covered_key"], "left").select("page_id", "url", "html", "covered")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op2_html_main_text": op2}
ORACLES: dict[str, str] = {}
