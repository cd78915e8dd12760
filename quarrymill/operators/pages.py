"""Fields of crawled pages: a small element tree by the standard parser, and what pages of sites and people give."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.functions.urls import bare, crawlable, person_link, segments
from quarrymill.session import shared_dir
from quarrymill.sources.sinks import exists

# Places of content and of links (fixed values).
MAIN = ("main", "article", ".content", ".main-content", "#content", "#main", ".post-content", ".entry-content", ".container", ".wrapper", "body")
PERSON_MAIN = ("main", "article", ".content", ".main-content", "#content", "#main", ".post-content", ".entry-content", ".teacher-detail", ".profile", ".bio")
PAGERS = (".pagination", ".pager", ".page-nav", "*pagination", "*pager", "*page")
LIST_MAIN = ("main", ".content", ".main-content", "#content", "#main")
LIST_LINKS = (
    "table tbody tr td a", "table tbody tr a", ".teacher-list a", ".teacher-item a", "*teacher a", "*faculty a", "ul li a", ".list-item a", ".search-result a",
    "article a", "main a", ".content a",
)
PERSON_EMAIL = re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b")
SITE_WORDS = ("个人主页", "个人网站", "personal", "homepage", "website")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(("script", "style", "noscript", "template"))
_CONTROL = re.compile("[\x00-\x08\x0b-\x0c\x0e-\x1f\x7f-\x9f]")
MOST_PARAGRAPHS = 50


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order; without recursion, so that depth is no limit."""
        todo = list(reversed(self.children))
        while todo:
            x = todo.pop()
            if isinstance(x, Element):
                yield x
                todo += reversed(x.children)

    def strings(self) -> Iterator[str]:
        todo = list(reversed(self.children))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in UNSEEN:
                todo += reversed(x.children)

    def text(self, between: str = "") -> str:
        return between.join(s for x in self.strings() if (s := x.strip()))

    def matches(self, selector: str) -> bool:
        """By tag, ``.class``, ``#id`` or ``*part of the class attribute``."""
        kinds = self.attrs.get("class") or ""
        if selector[0] == ".":
            return selector[1:] in kinds.split()
        if selector[0] == "#":
            return self.attrs.get("id") == selector[1:]
        return selector[1:] in kinds if selector[0] == "*" else self.tag == selector

    def first(self, selector: str) -> Element | None:
        return next((x for x in self.walk() if x.matches(selector)), None)

    def all(self, *tags: str) -> list[Element]:
        return [x for x in self.walk() if x.tag in tags]


class _Builder(HTMLParser):
    """Elements as they are written: an end tag closes down to its start tag, or nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open, self.counts = [self.root], {}

    def handle_starttag(self, tag, attrs):
        x = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(x)
        if tag not in VOID:
            self.open.append(x)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        while self.counts.get(tag, 0):
            closed = self.open.pop().tag
            self.counts[closed] -= 1
            if closed == tag:
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def repaired(s: str) -> str:
    """UTF-8 that was read as Latin-1, read again: what :func:`quarrymill.functions.text.mojibake_repaired` does."""
    ideograph = lambda c: "\u4e00" <= c <= "\u9fff" or "\u3400" <= c <= "\u4dbf"
    if len(s) >= 10 and any(ord(c) > 127 and not ideograph(c) for c in s[:100]):
        fixed = s.encode("latin-1", "ignore").decode("utf-8", "ignore")
        if len(fixed) > len(s) * 0.5:
            return fixed
    return s


def clean_line(s: str) -> str:
    return _CONTROL.sub("", s.strip())


def title(root: Element) -> str:
    """Of the first of title, h1 and h2 that there is, even if it is empty; its encoding repaired."""
    found = root.first("title") or root.first("h1") or root.first("h2")
    return repaired(_CONTROL.sub("", found.text())).strip() if found else ""


def main_text(root: Element, places=MAIN, least: int = 50) -> str:
    """The text of the first place with more than ``least`` characters, or of the whole page."""
    for place in places:
        found = root.first(place)
        if found and len(text := found.text("\n")) > least:
            return text
    return "\n".join(s for line in root.text("\n").split("\n") if (s := clean_line(line)))


def link_url(url: str, href: str) -> str:
    try:
        return urldefrag(urljoin(url, href))[0].rstrip("/")
    except ValueError:
        return ""


def links(root: Element, url: str) -> list[tuple[str, str]]:
    """(text, url) of links with a text."""
    return [(text, link_url(url, href)) for a in root.all("a") if (href := a.attrs.get("href")) and (text := a.text())]


def linked(url: str, links_: list[Element]) -> list[tuple[str, str]]:
    """(text, url) of links with a target, the url as it is joined."""
    out = []
    for a in links_:
        if href := a.attrs.get("href"):
            try:
                out.append((a.text(), urljoin(url, href)))
            except ValueError:
                continue
    return out


def list_links(root: Element, url: str) -> list[tuple[str, str]]:
    """The links that the places of lists have, place by place; a place is an order of ancestors."""
    found: list[list[Element]] = [[] for _ in LIST_LINKS]
    places = [p.split()[:-1] for p in LIST_LINKS]
    todo: list[tuple[Element, tuple[int, ...]]] = [(root, (0,) * len(places))]
    while todo:  # with each element goes how much of each place its ancestors are
        x, met = todo.pop()
        for child in reversed([c for c in x.children if isinstance(c, Element)]):
            now = tuple(n + (n < len(p) and child.matches(p[n])) for n, p in zip(met, places))
            todo.append((child, now))
        if x.tag == "a":
            for k, (n, p) in enumerate(zip(met, places)):
                if n == len(p):
                    found[k].append(x)
    return linked(url, [a for links_ in found for a in links_])


def area_links(root: Element, url: str) -> list[tuple[str, str]]:
    """The links of a list's main area, the first in the page of what may be one, or of the whole page."""
    area = next((x for x in root.walk() if any(x.matches(p) for p in LIST_MAIN)), root)
    return linked(url, area.all("a"))


def most_page(root: Element) -> int:
    """The largest page number that links and pagers name; 1 without any. Longs end where they end."""
    numbers = [1]
    numbers += [int(m[1][-4000:]) for a in root.all("a") if (m := re.search(r"page=(\d+)", a.attrs.get("href", "")))]
    pagers = [root.first(p) for p in PAGERS] + [next((x for x in root.all("nav") if word in x.attrs.get("aria-label", "")), None) for word in ("页", "page")]
    for pager in filter(None, pagers):
        numbers += [n for m in re.findall(r"\b\d+\b", "".join(pager.strings())) if len(m.lstrip("0")) <= 4 and 1 <= (n := int(m[-5:])) <= 1000]
    return min(max(numbers), (1 << 63) - 1)


def personal_site(root: Element, url: str) -> str | None:
    """The first link that names a personal site."""
    return next((u for text, u in links(root, url) if any(w in text.lower() for w in SITE_WORDS)), None)


def meta_description(root: Element) -> str:
    meta = next((m for m in root.all("meta") if m.attrs.get("name") == "description"), None)
    return meta.attrs.get("content", "").strip() if meta else ""


def paragraphs(root: Element) -> list[str]:
    return [c for p in root.all("p", "div") if len(t := p.text()) > 20 and (c := _CONTROL.sub("", t))][:MOST_PARAGRAPHS]


def person(root: Element, url: str) -> dict:
    name = root.first("h1") or root.first("h2")
    email = PERSON_EMAIL.search(root.text("\n"))
    return {"name": name.text() if name else "", "email": email[0] if email else "", "content": main_text(root, PERSON_MAIN), "site": personal_site(root, url)}


def _pairs(found: list[tuple[str, str]]) -> list[dict]:
    return [dict(zip(("text", "url"), x)) for x in found]


_LINK = pa.list_(pa.struct([("text", pa.string()), ("url", pa.string())]))
_PERSON = pa.struct([("name", pa.string()), ("email", pa.string()), ("content", pa.string()), ("site", pa.string())])
_LINKS_DDL = "array<struct<text:string,url:string>>"
#: Of each field: how it is made of (tree, url, the page's content), its type here and in Spark.
FIELDS = {
    "title": (lambda root, url, content: title(root), pa.string(), "string"),
    "content": (lambda root, url, content: content, pa.string(), "string"),
    "paragraphs": (lambda root, url, content: paragraphs(root), pa.list_(pa.string()), "array<string>"),
    "links": (lambda root, url, content: _pairs(links(root, url)), _LINK, _LINKS_DDL),
    "meta_description": (lambda root, url, content: meta_description(root), pa.string(), "string"),
    "word_count": (lambda root, url, content: len(content.split()), pa.int64(), "long"),
    "max_page": (lambda root, url, content: most_page(root), pa.int64(), "long"),
    "person": (lambda root, url, content: person(root, url), _PERSON, "struct<name:string,email:string,content:string,site:string>"),
    "list_links": (lambda root, url, content: _pairs(list_links(root, url)), _LINK, _LINKS_DDL),
    "area_links": (lambda root, url, content: _pairs(area_links(root, url)), _LINK, _LINKS_DDL),
}


def page_fields(html: str | None, url: str | None, wanted: Iterable[str] = tuple(FIELDS)) -> dict:
    """The wanted fields of a page; a null page is an empty one."""
    root, url, wanted = parse(html), url or "", tuple(wanted)
    content = main_text(root) if {"content", "word_count"} & set(wanted) else ""
    return {k: FIELDS[k][0](root, url, content) for k in wanted}


def extracted(pages: DataFrame, *wanted: str, key: str = "page_id") -> DataFrame:
    """(key, url, and the wanted fields of each page, all without any). Null pages are empty ones."""
    wanted = wanted or tuple(FIELDS)

    def rows(found):
        for b in found:
            got = [page_fields(h, u, wanted) for u, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([g[k] for g in got], FIELDS[k][1]) for k in wanted)], names=[key, "url", *wanted])

    ddl = ", ".join(f"{k} {FIELDS[k][2]}" for k in wanted)
    return pages.select(key, "url", "html").mapInArrow(rows, f"{key} {pages.schema[key].dataType.simpleString()}, url string, {ddl}")


def link_rows(fields: DataFrame, key: str = "page_id") -> DataFrame:
    return fields.select(key, F.posexplode("links").alias("pos", "link")).select(key, "pos", F.col("link.text").alias("text"), F.col("link.url").alias("url"))


def site_tree(pages: DataFrame) -> DataFrame:
    """The site map as rows: (path_segments, url, title)."""
    return pages.select(segments(F.col("url")).alias("path_segments"), "url", "title")


def frontier(start: DataFrame, fetch, hosts: list[str], depth: int, most: int, state: str | None = None) -> DataFrame:
    """Breadth-first rounds: from (url) pages to the crawlable links of their pages that weren't met before.

    ``fetch`` takes (url) and gives (url, links); urls it doesn't give weren't read. A round is a table: exploded
    links, without those known, once each. It ends after ``depth`` rounds, at ``most`` pages, or with an empty round.
    Returns (url, round) of the pages that were read. ``state`` names a folder, the shared one without it, with what was
    met and read by round: a later call with the same folder goes on where the last one ended, and a round that was cut
    short is written again.
    """
    spark = start.sparkSession
    state = state or f"{shared_dir(spark)}/frontier-{uuid.uuid4().hex}"
    table = lambda name: spark.read.schema("url string, round long").parquet(f"{state}/{name}")
    if not exists(spark, f"{state}/met"):
        start.select("url").distinct().write.mode("overwrite").parquet(f"{state}/met/round=0")
    first = 0
    if exists(spark, f"{state}/read"):
        first = (table("read").agg(F.max("round")).first()[0] or 0) + 1
        left = table("met").where(F.col("round") < first).join(table("read").select("url"), "url", "left_anti").select("url")
        # Pages that the last call had no room for count as the next round's.
        left.write.mode("append").parquet(f"{state}/met/round={first}")
    for k in range(first, depth + 1):
        room = most - (table("read").count() if exists(spark, f"{state}/read") else 0)
        if room <= 0:
            break
        now = table("met").where(F.col("round") == k).select("url").distinct()
        read = fetch(now.orderBy("url").limit(room)).checkpoint()
        read.select("url").write.mode("overwrite").parquet(f"{state}/read/round={k}")
        found = read.select(F.explode("links").alias("link")).select(F.col("link.url").alias("url")).where(crawlable(F.col("url"), hosts)).distinct()
        found.join(table("met").where(F.col("round") <= k).select("url"), "url", "left_anti").write.mode("overwrite").parquet(f"{state}/met/round={k + 1}")
        if table("met").where(F.col("round") == k + 1).isEmpty():
            break
    return table("read")


def person_links(fields: DataFrame, key: str = "page_id", other_sites: tuple[str, ...] = ()) -> DataFrame:
    """(key, pos, text, url) of a list's links to single persons: of the places of lists, or of the main area where those
    have none; the first of those that differ in query or fragment alone."""
    good = lambda column: F.filter(column, lambda x: person_link(x.url, x["text"], other_sites))
    chosen = T.let(good("list_links"), lambda a: F.when(F.size(a) > 0, a).otherwise(good("area_links")))
    rows = fields.select(key, F.posexplode(chosen).alias("pos", "link")).select(key, "pos", F.col("link.text").alias("text"), F.col("link.url").alias("url"))
    first = rows.groupBy(key, bare(F.col("url")).alias("page")).agg(F.min(F.struct("pos", "text", "url")).alias("link"))
    return first.select(key, "link.*")
