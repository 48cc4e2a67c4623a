"""Main text of web pages by consensus of their host.

Every page scores its containers; the path of the best one (tags and classes,
numbers generalised) is its vote.  Votes are counted per host in Spark, and
each page is extracted again with the winning path, so a page that would
mislead a reader on its own is read like its siblings.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.functions.joins import broadcast_if_small
from tideframe.llm.common import written

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S,
)
#: The same without quotes: for what follows a tag whose quote never ends.
UNQUOTED = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title noscript iframe template xmp svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: What else ends where one of these begins.
ENDS_BEFORE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPE = frozenset("ul ol dl table body html article main section div nav aside footer header form".split())
CONTAINERS = frozenset("article main section div body".split())
JUNK_TAGS = frozenset("nav footer aside button select input dialog menu head".split())
JUNK_WORDS = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored banner promo promotion sidebar"
    " menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus reply"
    " replies respond cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe"
    " signup login share sharing social related recommended widget widgets toolbar pagination pager"
    " skip hidden".split()
)
#: Of these, such as also name the layout or state of what holds the article.
STATE_WORDS = frozenset(
    "ad ads banner promo sidebar menu nav navbar navigation masthead footer reply notice alert modal"
    " overlay share sharing social related recommended widget widgets toolbar skip hidden".split()
)
#: So begins the name of a state, as in no-sidebar.
STATES = frozenset("no has with without hide is".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: A path names so many steps, the innermost; the outer ones are one hash.
STEPS = 12
#: Shares of text: what is beside a container and belongs to it, and what of that may be linked.
BESIDE, LINKED = 0.2, 0.3
GOOD_TAGS = {"article": 60, "main": 40}
GOOD_WORDS = frozenset("article content entry main post story body text".split())


@dataclass
class Element:
    tag: str
    steps: tuple[str, ...] = ()
    junk: bool = False
    page_header: bool = False
    #: Text blocks and child elements, in order; a str is text within a block, None a break.
    parts: list = field(default_factory=list)
    children: list = field(default_factory=list)
    bonus: int = 0
    #: A form, or named by a word that is junk unless most of the page's text is inside.
    doubtful: bool = False
    #: Doubtful, and junk also then, unless a first heading is inside.
    untitled_junk: bool = False
    #: Holds a first heading; a first or second one.
    h1: bool = False
    title: bool = False

    @property
    def path(self) -> str:
        return ">".join(self.steps)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(text)}


def _element(tag: str, attributes: str, parent: Element) -> Element:
    a = _attributes(attributes) if attributes.strip(" /") else {}
    tokens = [
        re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", t).lower())
        for t in f"{a.get('class', '')} {a.get('id', '')}".split()
    ]
    words = [w for t in tokens for w in t]
    junk_words = JUNK_WORDS.intersection(w for t in tokens if t and not (len(t) > 1 and t[0] in STATES) for w in t)
    good = any(GOOD_WORDS.intersection(t) and not JUNK_WORDS.intersection(t) for t in tokens)
    names = "".join(f".{re.sub(r'[0-9]+', '#', c.lower())}" for c in sorted(a.get("class", "").split()))
    style = a.get("style", "").replace(" ", "").lower()
    body = tag in ("body", "html", "article", "main")
    junk = (
        tag in JUNK_TAGS
        or a.get("role", "").lower() in JUNK_ROLES
        or "hidden" in a or a.get("aria-hidden", "") == "true"
        or "display:none" in style or "visibility:hidden" in style
    )
    if tag in INLINE:
        steps = parent.steps
    else:
        steps = (*(() if tag in ("html", "body") else parent.steps), tag + names)
        if len(steps) > STEPS:
            steps = (f"{zlib.crc32('>'.join(steps[:2]).encode()):08x}", *steps[2:])
    bonus = GOOD_TAGS.get(tag, 0) + 15 * bool(GOOD_WORDS.intersection(words))
    return Element(tag, steps, junk or parent.junk, bonus=bonus, doubtful=tag == "form" or not body and bool(junk_words),
                   untitled_junk=not good and not junk_words <= STATE_WORDS, page_header=tag == "header" or a.get("role") == "banner")


class _Open:
    """The open elements, and where on the stack each kind of them stands."""

    def __init__(self, root: Element):
        self.stack = [root]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def last(self, tag: str) -> int:
        """Place of the innermost open element of this tag; 0 if none."""
        places = self.at.get(tag)
        return places[-1] if places else 0

    def push(self, e: Element) -> None:
        k = len(self.stack)
        self.stack.append(e)
        self.at.setdefault(e.tag, []).append(k)
        if e.tag not in INLINE:
            self.blocks.append(k)
        if e.tag in SCOPE:
            self.scopes.append(k)

    def cut(self, k: int) -> None:
        """Ends the elements from place k on."""
        while len(self.stack) > k:
            tag = self.stack.pop().tag
            self.at[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
            if tag in SCOPE:
                self.scopes.pop()

    def close(self, tags: set[str]) -> None:
        """Ends the innermost element of these tags, but none around the scope."""
        k = max(map(self.last, tags))
        if k and (not self.scopes or k >= self.scopes[-1]):
            self.cut(k)

    def end(self, tag: str) -> None:
        """An end tag: an inline one ends no block, others end no scope but their own."""
        k = self.last(tag)
        around = self.blocks if tag in INLINE else [] if tag in SCOPE else self.scopes
        if k and not (around and around[-1] > k):
            self.cut(k)

    def titled(self, tag: str) -> None:
        for e in reversed(self.stack):
            if e.title and (e.h1 or tag != "h1"):
                break
            e.title, e.h1 = True, e.h1 or tag == "h1"


def parse(page: str) -> Element:
    """The tree of a page, however badly its tags are closed; in time that grows with its length."""
    root = Element("")
    now, at, markup = _Open(root), 0, MARKUP
    #: Behind the last > there are no whole tags to look for.
    whole = page.rfind(">") + 1

    def text(t: str) -> None:
        if t:
            now.stack[-1].parts.append(html.unescape(t) if "&" in t else t)

    while True:
        m = markup.search(page, at, whole)
        if m is None:
            break
        text(page[at:m.start()])
        at = m.end()
        if markup is MARKUP:
            tag, closing, attributes = m[2] or m[5], m[1] or m[4], m[3] or m[6] or ""
            markup = UNQUOTED if m[5] else MARKUP
        else:
            tag, closing, attributes = m[2], m[1], m[3]
        if tag is None:
            for begin, end in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if m[0].startswith(begin):
                    at = at if m[0].endswith(end) else len(page)
                    break
            continue
        tag = tag.lower()
        if closing:
            now.end(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at, whole)
            at = end.end() if end else len(page)
            continue
        if tag not in INLINE and tag not in VOID:
            now.close({"p"})
        if tag in ENDS_BEFORE:
            now.close(ENDS_BEFORE[tag])
        if tag == "br":
            now.stack[-1].parts.append(" ")
        elif tag == "hr":
            now.close({"p"})
            now.stack[-1].parts.append(None)
        elif tag not in VOID:
            e = _element(tag, attributes, now.stack[-1])
            now.stack[-1].parts.append(e)
            now.stack[-1].children.append(e)
            now.push(e)
            if tag in ("h1", "h2"):
                now.titled(tag)
    tail = page[at:]
    if found := re.search("<[!?]", tail):
        tail = tail[:found.start()]
    text(tail)
    _settle(root)
    return root


def _settle(root: Element) -> None:
    """Doubtful elements are junk, but for containers of most of the page's text that is not mostly linked."""
    order = list(_walk(root))
    if not any(e.doubtful for e in order):
        return
    sums: dict[int, tuple[int, int]] = {}
    for e in reversed(order):
        chars = sum(len(p.strip()) for p in e.parts if isinstance(p, str))
        inner = [sums[id(c)] for c in e.children]
        chars += sum(c for c, _ in inner)
        sums[id(e)] = chars, chars if e.tag == "a" else sum(n for _, n in inner)
    for e in order:
        if e.doubtful and not e.junk:
            chars, linked = sums[id(e)]
            e.junk = (e.tag not in CONTAINERS and e.tag != "form" or 2 * chars <= sums[id(root)][0]
                      or 2 * linked >= chars or e.untitled_junk and not e.h1
                      or e.tag == "form" and not e.h1 and not any(c.tag in CONTAINERS or c.tag == "p" for c in _walk(e)))
        for c in e.children:
            c.junk = c.junk or e.junk


def _pieces(e: Element, top: bool = True) -> Iterator[str | None]:
    """Text, and None at the borders of blocks."""
    todo = [(e, iter(e.parts))]
    while todo:
        now, parts = todo[-1]
        for p in parts:
            if isinstance(p, Element):
                if p.junk and not e.junk or p.page_header and not p.title:
                    yield None
                    continue
                if p.tag not in INLINE:
                    yield None
                todo.append((p, iter(p.parts)))
                break
            yield p
        else:
            todo.pop()
            if now.tag not in INLINE:
                yield None


def blocks(e: Element) -> list[str]:
    """The text blocks of an element without what is not its content."""
    out, now = [], []
    for p in _pieces(e):
        if p is None:
            if block := " ".join("".join(now).split()):
                out.append(block)
            now = []
        else:
            now.append(p)
    if block := " ".join("".join(now).split()):
        out.append(block)
    return out


def _walk(e: Element) -> Iterator[Element]:
    todo = [e]
    while todo:
        now = todo.pop()
        yield now
        todo += reversed(now.children)


def _own_text(e: Element) -> tuple[int, int, int]:
    """Characters, commas and linked characters of an element without its inner containers."""
    chars = commas = linked = 0
    todo = [(e, False)]
    while todo:
        now, link = todo.pop()
        for p in now.parts:
            if isinstance(p, Element):
                if not p.junk and p.tag not in CONTAINERS:
                    todo.append((p, link or p.tag == "a"))
            elif p is not None:
                n = len(p.strip())
                chars += n
                commas += p.count(",")
                linked += n if link else 0
    return chars, commas, linked


def _beside(parent: Element, inner: Element) -> tuple[int, int, bool]:
    """Of what an element holds besides one of its children: characters, linked characters,
    and whether there is a first heading that is neither a link nor in a header."""
    chars = linked = 0
    heading = False
    todo = [(parent, False, False)]
    while todo:
        now, link, head = todo.pop()
        if now.tag == "h1" and not head and not link:
            own, _, links = _own_text(now)
            heading = heading or own > links
        for p in now.parts:
            if isinstance(p, Element):
                if p is not inner and not p.junk:
                    todo.append((p, link or p.tag == "a", head or p.page_header))
            elif p is not None:
                chars += len(p.strip())
                linked += len(p.strip()) if link else 0
    return chars, linked, heading


def _whole(e: Element, parents: dict[int, Element], chars: int) -> Element:
    """The container that holds the rest of an article of which ``e`` is a part.

    That is the parent, when beside ``e`` are the first heading that ``e``
    lacks, or a good part of unlinked text in elements of the same tag; and so
    on outwards, but never the body.
    """
    best = now = e
    while (up := parents.get(id(now))) is not None and up.tag not in ("", "html", "body") and not up.junk:
        more, linked, heading = _beside(up, now)
        alike = any(c is not now and c.tag == now.tag and not c.junk for c in up.children)
        chars += more
        if up.tag in CONTAINERS and (
            heading and not best.h1 or alike and more >= BESIDE * chars and linked <= LINKED * more
        ):
            best = up
        elif more:
            break
        now = up
    return best


def best_container(root: Element) -> tuple[Element | None, int]:
    """The container whose own text is most like an article, and its score.

    Within an article, or else a main part, it is the innermost of these.
    Elsewhere it is what holds all of the article, see ``_whole``.
    """
    best = part = None
    most = size = 0
    parents: dict[int, Element] = {}
    todo: list[tuple[Element, Element | None]] = [(root, None)]
    while todo:
        e, whole = todo.pop()
        if e.tag == "article" or e.tag == "main" and (whole is None or whole.tag == "main"):
            whole = e
        for c in reversed(e.children):
            parents[id(c)] = e
            todo.append((c, whole))
        if e.tag in CONTAINERS and not e.junk and not e.page_header:
            chars, commas, linked = _own_text(e)
            if chars:
                score = int((1 + chars / 25 + commas + e.bonus) * (1 - linked / chars))
                if score > most:
                    best, part, most, size = whole, e, score, chars
    return (best or part and _whole(part, parents, size)), most


def host(url: Column) -> Column:
    """Lower-case host of a URL; '' where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def votes(pages: DataFrame) -> DataFrame:
    """host, path, score: the best container of each page that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [best_container(parse(h or "")) for h in b.column("html").to_pylist()]
            keep = pa.array([e is not None for e, _ in found])
            yield pa.RecordBatch.from_arrays(
                [b.column("host").filter(keep), pa.array([e.path for e, _ in found if e is not None], pa.string()),
                 pa.array([s for e, s in found if e is not None], pa.int64())], ["host", "path", "score"])

    return pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, score long")


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the path with most votes; of equals that with the higher score, then the later name."""
    return (
        votes(pages).groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))
        .groupBy("host").agg(F.max(F.struct("votes", "score", "path"))["path"].alias("path"))
    )


def extract(page: str, path: str | None) -> str:
    """Text of the elements at ``path``; without any, of the page's own best container."""
    root = parse(page)
    found: list[Element] = []
    todo = [root] if path is not None else []
    while todo:
        e = todo.pop()
        if e.tag in CONTAINERS and not e.junk and e.path == path:
            found.append(e)
        else:
            todo += reversed(e.children)
    texts = [b for e in found for b in blocks(e)]
    if not texts:
        texts = blocks(best_container(root)[0] or root)
    return "\n\n".join(texts)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    NULL or empty html gives empty text.  Pages with no host form one host of
    their own.  Repeated rows are each extracted (and each vote); other
    columns are not read.  An empty table stays empty.

    The paths are one short row per host.  They are broadcast when measured to
    be small, otherwise joined by host, where AQE splits a hot one.
    """
    paths = broadcast_if_small(written(host_paths(pages), "host-paths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [extract(h or "", p) for h, p in zip(b.column("html").to_pylist(), b.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("host", host(F.col("url")))
    return rows.join(paths, "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
