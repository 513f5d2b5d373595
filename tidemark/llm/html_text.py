"""Operator 2: main text of web pages, with site templates removed by counted subtree hashes.

Every page is read into elements. The subtrees of its content are hashed (tags and text; neither classes nor links, which
sites rename at will) and counted by host: one that recurs with many different articles of its host (MIN_ARTICLES, at every size of the
host) is part of the site's template and is deleted wherever it occurs on that host. What markup declares assists: the
content is what ``article`` (else ``main``, else the body) holds, and elements that declare themselves as menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, hidden or reader comments go, too; their texts may differ from page to
page, so that counts can't find them.

Copies of one article count once: by all of its text where markup tells what the article is, else by the two longest
blocks of the page. Prose (paragraphs, headings, and in a declared article also lists and tables) is never a template on
its own, so texts that sites republish stay. Trees are read as a flat list of events, so depth costs nothing.

A name declares an element only if it says nothing else: ``reader-comments`` and ``ad_slot`` do, ``social-history`` doesn't. A
name, or an enclosing form, that would drop the only article of a page doesn't count.

Defined results: null html gives an empty text. Unclosed elements and markup cut off at the end are read as a
browser would. Repeated rows each keep their row; the template counts see them once. A null url is a host of its
own. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.url_filters import host_of

#: With no more pages than this that hold a template, Spark chooses the join by the size of what was written about them.
FEW_PAGES = 20_000
#: A subtree is a template if it occurs with so many different articles of a host.
MIN_ARTICLES = 5

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z_:-][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE) for tag in RAW}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("head title script style noscript template nav header footer aside form button select option textarea input iframe svg canvas object dialog menu xmp noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may be a template: in a declared article, and on pages that declare none.
CONTAINERS = frozenset("div section nav header footer aside form menu center".split())
ANYWHERE = CONTAINERS | frozenset("ul ol li dl table tr".split())
#: Words of names that declare what isn't content, and words that say nothing beside them.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related respond share sharing sidebar skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
PLAIN = frozenset("a and area bar block body bottom box buttons center col column container content form global group head header icons id in inner item items layer left link links list main media mobile new of on order outer overlay page panel post posts primary reader readers right row secondary section site slot sticky tag text the thread title to top unit user users wrap wrapper zone".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Elements that a new one of the key ends, up to the nearest of the bounds.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: A stray end tag doesn't reach beyond these; they end only by these themselves.
WALLS = frozenset("article body table".split())
OUTER = frozenset("html body article main table".split())


def declared(names: str) -> bool:
    """Whether a class or an identifier names nothing but what isn't content."""
    for name in names.split():
        words = WORD.findall(name)
        if words and not BOILERPLATE.isdisjoint(words) and all(w in BOILERPLATE or w in PLAIN for w in words):
            return True
    return False


class Element:
    """An element: ``start`` and ``end`` are the places of its events. ``drop``: it isn't content; ``hard``: for certain, not only by its name."""

    __slots__ = ("tag", "drop", "hard", "main", "parent", "block", "start", "end")

    def __init__(self, tag: str, attributes: str, parent: Element | None, start: int):
        self.tag, self.parent, self.start, self.end = tag, parent, start, start
        #: The nearest element that isn't inline: itself or one above.
        self.block = self if parent is None or tag not in INLINE else parent.block
        soft, self.hard = tag == "form", tag in DROPPED and tag != "form"
        self.main = tag in ("article", "main")
        if attributes and ("=" in attributes or "hidden" in attributes.lower()):
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            if tag not in ("main", "body", "html"):
                self.hard |= found.get("role", "").lower() in ROLES or "hidden" in found
                soft |= declared(f"{found.get('class', '')} {found.get('id', '')}".lower())
            self.main |= found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody"
        self.drop = self.hard or soft


class Page:
    """Elements in page order (the root first), and events: a text, the number of an element that begins, or ~ that of one that ends."""

    def __init__(self, html: str):
        self.elements: list[Element] = []
        self.events: list[str | int] = []
        self._parse(html)
        self.content = self._content()

    def _begin(self, tag: str, attributes: str, parent: Element | None) -> Element:
        x = Element(tag, attributes, parent, len(self.events))
        self.events.append(len(self.elements))
        self.elements.append(x)
        return x

    def _end(self, x: Element) -> None:
        x.end = len(self.events)
        self.events.append(~self.events[x.start])

    def _end_up_to(self, here: Element, above: Element) -> Element:
        while here is not above:
            self._end(here)
            here = here.parent
        return here

    def _parse(self, html: str) -> None:
        root = here = self._begin("html", "", None)
        at, seek, events = 0, TOKEN.search, self.events
        while m := seek(html, at):
            tag = m[2].lower() if m[2] else ""
            if m.start() > at:
                events.append(unescape(html[at : m.start()]))
            at = m.end()
            if not tag or m[4] != ">":
                continue
            if m[1]:
                node = here
                while node is not root and node.tag != tag:
                    node = root if node.tag in WALLS and tag not in OUTER else node.parent
                if node is not root:
                    here = self._end_up_to(here, node.parent)
                continue
            if tag in ("html", "body"):
                if tag == "body":
                    here = self._end_up_to(here, root)
                continue
            if tag in VOID:
                if tag == "br":
                    events.append(" ")
                elif tag == "hr":
                    self._end(self._begin(tag, m[3], here))
                continue
            ends, bounds = IMPLIED.get(tag, (None, None))
            if ends:
                node = here
                while node is not root and node.tag not in bounds and node.tag not in ends:
                    node = node.parent
                if node.tag in ends:
                    here = self._end_up_to(here, node.parent)
            elif tag not in INLINE:
                # A block ends an open paragraph, and with it the inline elements left open in it.
                node = here.block
                while node is not root and node.tag in HEADINGS and tag in HEADINGS:
                    node = node.parent.block
                if node.tag == "p":
                    here = self._end_up_to(here, node.parent)
            child = self._begin(tag, m[3], here)
            if tag in RAW:  # no markup inside, up to its own end tag
                end = RAW_END[tag].search(html, at)
                if tag == "title":
                    events.append(unescape(html[at : end.start() if end else len(html)]))
                at = end.end() if end else len(html)
                self._end(child)
            elif m[3].endswith("/"):
                self._end(child)
            else:
                here = child
        if at < len(html):
            events.append(unescape(html[at:]))
        self._end(self._end_up_to(here, root))

    def _mains(self) -> list[Element]:
        """The outermost articles that aren't in dropped parts, else the outermost main elements."""
        found: dict[bool, list[Element]] = {True: [], False: []}
        until = {True: 0, False: 0}
        dropped = 0
        for x in self.elements[1:]:
            if x.start < dropped:
                continue
            if x.drop:
                dropped = x.end
            elif x.main and x.start >= until[x.tag == "article"] and x.start >= until[True]:
                found[x.tag == "article"].append(x)
                until[x.tag == "article"] = x.end
        return found[True] or found[False]

    def _content(self) -> list[Element]:
        if found := self._mains():
            return found
        # Names that drop all articles there are don't count.
        cleared: set[int] = set()
        for x in self.elements:
            if x.main and not x.hard:
                while x is not None and x.start not in cleared:
                    cleared.add(x.start)
                    x.drop = x.hard
                    x = x.parent
        return self._mains() or self.elements[:1]

    @property
    def told(self) -> bool:
        """Whether markup tells where the content is."""
        return self.content[0].parent is not None

    def blocks(self, node: Element, templates: frozenset = frozenset(), hashes: dict[int, bytes] | None = None) -> list[str]:
        """The blocks of an element, white space collapsed, without what is dropped and without templates."""
        blocks: list[str] = []
        run: list[str] = []
        events, elements, inside = self.events, self.elements, self.told

        def end() -> None:
            if run:
                if block := SPACE.sub(" ", "".join(run)).strip():
                    blocks.append(block)
                run.clear()

        i = node.start + 1
        while i < node.end:
            e = events[i]
            if e.__class__ is str:
                run.append(e)
            elif e < 0:
                if elements[~e].tag not in INLINE:
                    end()
            else:
                x = elements[e]
                if x.drop:
                    if x.tag == "header" and inside:  # an article's own: its headings are content
                        self._headings(x, run, end)
                    elif x.tag not in INLINE:
                        end()
                    i = x.end
                elif templates and hashes.get(e) in templates:
                    end()
                    i = x.end
                elif x.tag not in INLINE:
                    end()
            i += 1
        end()
        return blocks

    def _headings(self, x: Element, run: list[str], end) -> None:
        until = 0
        for i in range(x.start, x.end):
            e = self.events[i]
            if e.__class__ is str:
                if i < until:
                    run.append(e)
            elif e >= 0 and i >= until and self.elements[e].tag in HEADINGS:
                end()
                until = self.elements[e].end
            elif i == until:
                end()
        end()

    def hashes(self) -> dict[int, bytes]:
        """Digests of the subtrees of the content that may be templates, by the number of their element.

        A subtree's digest is made of its tag, its texts and the digests of the elements below.
        """
        kinds = CONTAINERS if self.told else ANYWHERE
        out: dict[int, bytes] = {}
        blake = hashlib.blake2b
        for node in self.content:
            open_: list[list[bytes]] = [[]]
            i = node.start + 1
            while i < node.end:
                e = self.events[i]
                if e.__class__ is str:
                    if text := SPACE.sub(" ", e).strip():
                        open_[-1].append(text.encode("utf-8", "replace"))
                elif e < 0:
                    tag = self.elements[~e].tag
                    own = blake(b"\x00".join([tag.encode("utf-8", "replace"), *open_.pop()]), digest_size=16).digest()
                    open_[-1].append(b"\x01" + own)
                    if tag in kinds:
                        out[~e] = own
                elif self.elements[e].hard:
                    i = self.elements[e].end
                else:
                    open_.append([])
                i += 1
        return out

    def article(self) -> bytes:
        """What counts as one article: all the text where markup tells it, else the two longest blocks."""
        blocks = [b for c in self.content for b in self.blocks(c)]
        if not self.told:
            blocks = sorted(sorted(blocks, key=lambda b: (-len(b), b))[:2])
        return hashlib.blake2b(" ".join(blocks).encode("utf-8", "replace"), digest_size=8).digest()

    def text(self, templates: frozenset = frozenset()) -> str:
        hashes = self.hashes() if templates else None
        return " ".join(b for c in self.content for b in self.blocks(c, templates, hashes))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, page, subtree, article: one row for each distinct subtree of a page that may be a template."""
    for batch in batches:
        hosts, pages, subtrees, articles = [], [], [], []
        for host, key, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            page = Page(html or "")
            own = set(page.hashes().values())
            if own:
                hosts += [host] * len(own)
                pages += [key] * len(own)
                subtrees += own
                articles += [page.article()] * len(own)
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(pages, pa.binary()), pa.array(subtrees, pa.binary()), pa.array(articles, pa.binary())], names=["host", "page", "subtree", "article"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [Page(html or "").text(frozenset(own or ())) for html, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, key: str = "page_id", min_articles: int = MIN_ARTICLES) -> DataFrame:
    """One row per page: ``key``, url, text, n_chars."""
    spark = pages.sparkSession
    common.small_batches(spark)
    # A page's templates follow from its host and html, so copies of a page share them.
    rows = pages.select(F.col(key).alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"), F.unhex(F.sha2("html", 256)).alias("page"))
    seen = common.cut(rows.select("host", "page", "html").mapInArrow(_hash, "host string, page binary, subtree binary, article binary"), "subtrees")
    counts = seen.select("host", "subtree", "article").distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    templates = common.cut(counts.filter(F.col("n") >= min_articles).select("host", "subtree"), "templates")
    # Gathered for one page at a time, never for a host.
    of_page = common.cut(seen.join(templates, ["host", "subtree"]).groupBy("host", "page").agg(F.collect_set("subtree").alias("templates")), "page-templates")
    for old in (seen, templates):
        common.drop_table(spark, old)
    kind = pages.schema[key].dataType.simpleString()
    # Many of them are hashed by partition, as sorting would move and order every html; few are broadcast, if they are small.
    of_page = of_page if of_page.count() <= FEW_PAGES else of_page.hint("shuffle_hash")
    out = rows.join(of_page, ["host", "page"], "left").select("page_id", "url", "html", "templates").mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars bigint")
    return out.withColumnRenamed("page_id", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
