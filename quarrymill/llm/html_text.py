"""HTML extraction: a tree with implied tags, visibility rules, and a layout of blocks, lists and aligned table cells."""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from collections import defaultdict
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from quarrymill.llm.common import sliced

#: HTML's element classes (fixed values of the standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template iframe object audio video canvas datalist noembed noframes title base link meta param rp".split())
#: What isn't rendered in drawings and formulas; their texts and cells stand apart.
FOREIGN = frozenset("svg math".split())
FOREIGN_HIDDEN = frozenset("annotation annotation-xml defs metadata desc symbol clippath mask marker pattern lineargradient radialgradient filter mphantom".split())
APART = frozenset("td th text mtd".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table pre blockquote figure fieldset hr".split())
BLOCK = SPACED | frozenset("html body address article aside center details dialog dd div dt figcaption footer form header hgroup legend li main nav optgroup option search section summary caption thead tbody tfoot tr".split())
CLOSE_P = SPACED | frozenset("address article aside center details dialog div figcaption footer form header hgroup main nav search section".split())
#: A start tag ends an open element of these, up to a boundary.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"optgroup"}, {"select"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
#: An end tag doesn't reach past these.
SCOPE = frozenset("table td th caption template".split())
WIDEST = 60
_SPACE = re.compile(r"[ \t\n\r\f]+")
_GONE = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(\w+)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Builds the tree as tags come. ``places`` has, by tag, where elements of it are among the open ones."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self.places[tag]:
            return
        if tag in CLOSE_P:
            self._end({"p"}, SCOPE | {"button"})
        if tag in ENDS:
            self._end(*ENDS[tag])
        if tag in ("tbody", "thead", "tfoot"):
            self._end(*ENDS["tr"])  # rows without a body of their own
        if tag in BLOCK or tag in ("table", "td"):
            self._end({"head"}, set())
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push("tr", {})
        node = Node(tag, dict(attrs))
        if self._foreign() and (tag in FOREIGN_HIDDEN or node.attrs.get("display") == "none"):
            node.attrs["hidden"] = None
        self._add(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and (tag in ("script", "style", "textarea", "title") or self._foreign()):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag == "p" and not self.places["p"]:
            self.open[-1].children.append(Node("p", {}))
        elif tag not in VOID:
            self._end({tag}, SCOPE - {tag})

    def handle_data(self, data):
        if data.strip():
            self._end({"head"}, {"title", "style", "script", "noscript", "template"})
        self.open[-1].children.append(data)

    def unknown_decl(self, data):
        if data.startswith("CDATA["):
            self.handle_data(data[6:])

    def _foreign(self):
        return any(self.places[t] for t in FOREIGN)

    def _push(self, tag, attrs):
        self._add(Node(tag, attrs))

    def _add(self, node):
        self.open[-1].children.append(node)
        if node.tag not in VOID:
            self.places[node.tag].append(len(self.open))
            self.open.append(node)

    def _last(self, tags):
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def _end(self, tags, boundary):
        """Closes down to the nearest open element of ``tags``, unless a boundary comes first."""
        k = self._last(tags)
        if k and k >= self._last(boundary):
            for node in self.open[k:]:
                self.places[node.tag].pop()
            del self.open[k:]


class Layout:
    """Lines of text; runs of white space become one space but in preformatted text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = self.want = 0

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self._put(first)
            for more in rest:
                self.end(True)
                self._put(more)
            return
        data = _SPACE.sub(" ", data)
        if data.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            data = data[1:]
        self._put(data)

    def _put(self, data: str) -> None:
        if data:
            if self.want and self.lines:
                self.lines += [""] * (self.want - self._blank())
            self.want = 0
            self.line.append(data)

    def _blank(self) -> int:
        return 1 if self.lines and not self.lines[-1] else 0

    def end(self, always: bool = False) -> None:
        """Ends the line; ``always``: an empty one too."""
        if self.line or always:
            self.lines.append("".join(self.line).rstrip(" \t"))
            self.line = []

    def block(self, spaced: bool) -> None:
        self.end()
        self.want = max(self.want, int(spaced))

    def add(self, lines: list[str]) -> None:
        for line in lines:
            if line:
                self._put(line)
            self.end(True)

    def done(self) -> list[str]:
        self.end()
        lines = self.lines
        while lines and not lines[-1].strip():
            lines.pop()
        while lines and not lines[0].strip():
            del lines[0]
        return lines


def displayed(node: Node) -> bool:
    attrs, tag = node.attrs, node.tag
    if tag in HIDDEN or "hidden" in attrs or _GONE.search(attrs.get("style") or ""):
        return False
    return not (tag == "dialog" and "open" not in attrs)


def render(node: Node, out: Layout, pre: bool = False, seen: bool = True, depth: int = 0) -> None:
    """Lays out a node's children. ``seen`` is CSS visibility, which children may set again."""
    closed = node.tag == "details" and "open" not in node.attrs
    first_summary = closed
    for child in node.children:
        if isinstance(child, str):
            if seen and not closed:
                out.text(child, pre)
            continue
        if closed:
            if child.tag != "summary" or not first_summary:
                continue
            first_summary = False
        if not displayed(child):
            continue
        tag, set_to = child.tag, _VISIBILITY.search(child.attrs.get("style") or "")
        shown = seen if not set_to else set_to[1].lower() not in ("hidden", "collapse")
        if tag == "br":
            out.end(True)
        elif tag == "table":
            out.block(True)
            out.add(table_lines(child, shown, depth))
            out.block(True)
        elif tag in ("ul", "ol", "menu", "dir"):
            out.block(depth == 0)
            list_items(child, out, shown, depth)
            out.block(depth == 0)
        elif tag == "li":
            item(child, out, "- ", shown, depth)
        elif tag in ("pre", "textarea", "listing"):
            out.block(tag != "textarea")
            if child.children and isinstance(child.children[0], str):
                child.children[0] = child.children[0].removeprefix("\n")
            render(child, out, True, shown, depth)
            out.block(tag != "textarea")
        elif tag in ("blockquote", "dd"):
            inner = Layout()
            render(child, inner, False, shown, depth)
            out.block(tag == "blockquote")
            out.add([("  " + line) if line else "" for line in inner.done()])
            out.block(tag == "blockquote")
        elif tag in BLOCK:
            out.block(tag in SPACED)
            render(child, out, pre, shown, depth)
            out.block(tag in SPACED)
        else:
            if tag in APART:
                out.text(" ", False)
            render(child, out, pre, shown, depth)
            if tag in APART - {"td", "th"}:
                out.text(" ", False)


def item(node: Node, out: Layout, mark: str, seen: bool, depth: int) -> None:
    inner = Layout()
    render(node, inner, False, seen, depth + 1)
    out.block(False)
    lines = inner.done()
    out.add([(mark if k == 0 else " " * len(mark)) + line if line else "" for k, line in enumerate(lines)])


def number(text: str | None, default: int) -> int:
    found = re.match(r"\s*([+-]?[0-9]{1,9})", text or "")
    return int(found[1]) if found else default


def list_items(node: Node, out: Layout, seen: bool, depth: int) -> None:
    n = number(node.attrs.get("start"), 1)
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li":
            n = number(child.attrs.get("value"), n)
            if displayed(child):
                item(child, out, f"{n}. " if node.tag == "ol" else "- ", seen, depth)
            n += 1
        else:
            other = Node("div", {})
            other.children.append(child)
            render(other, out, False, seen, depth + 1)


def table_lines(table: Node, seen: bool, depth: int) -> list[str]:
    """The lines of a table: cells start at their column's place; columns count as WIDEST at most, texts are whole."""
    head, rows, tail = Layout(), [], Layout()
    todo = list(reversed(table.children))
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            if part.strip() and seen:
                head.text(part, False)
        elif displayed(part):
            if part.tag in ("thead", "tbody", "tfoot"):
                todo += reversed(part.children)
            elif part.tag == "tr":
                rows.append(part)
            else:
                other = Node("div", {})
                other.children.append(part)
                render(other, head, False, seen, depth)
    grid: list[list[tuple[int, int, list[str]]]] = []
    taken: list[tuple[int, int, int]] = []  # (start, end, row) of columns that a cell keeps up to a row, by start
    widths: dict[int, int] = {}
    for n, row in enumerate(rows):
        cells, at, held, new = [], 0, iter([*taken, (1 << 62, 1 << 62, 0)]), []
        next_held = next(held)
        loose = Node("td", {})
        for cell in [*row.children, loose]:
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                if not isinstance(cell, str) or cell.strip():
                    loose.children.append(cell)
                continue
            if not displayed(cell) or cell is loose and not loose.children:
                continue
            while next_held[0] <= at:
                at = max(at, next_held[1])
                next_held = next(held)
            span = max(1, min(1000, number(cell.attrs.get("colspan"), 1)))
            down = max(1, min(65534, number(cell.attrs.get("rowspan"), 1)))
            inner = Layout()
            render(cell, inner, False, seen, depth)
            lines = inner.done()
            cells.append((at, span, lines))
            if span == 1:
                widths[at] = max(widths.get(at, 0), min(WIDEST, max(map(len, lines), default=0)))
            if down > 1:
                new.append((at, at + span, n + down))
            at += span
        taken = sorted(t for t in [*taken, *new] if t[2] > n + 1)
        grid.append(cells)
    columns = sorted(c for c, width in widths.items() if width)
    ends = list(accumulate((widths[c] + 2 for c in columns), initial=0))
    out = head.done()
    for cells in grid:
        starts = [ends[bisect_left(columns, at)] for at, _, _ in cells]
        for k in range(max((len(lines) for _, _, lines in cells), default=0)):
            line = ""
            for (_, _, lines), start in zip(cells, starts):
                if k < len(lines) and lines[k]:
                    line = (line.ljust(start) if len(line) + 2 <= start or not line else line + "  ") + lines[k]
            out.append(line)
    return out + tail.done()


def visible_text(html: str | None) -> str:
    """All visible text of a page. Null and empty pages give an empty text; text without tags is a page too. Elements
    may be nested as deeply as the page is long: layout recurses, and calls of Python functions only take memory."""
    builder = TreeBuilder()
    builder.feed((html or "").replace("\0", ""))
    builder.close()
    out, limit = Layout(), sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 6 * len(html or "") + 10_000))
    try:
        render(builder.root, out)
    finally:
        sys.setrecursionlimit(limit)
    return "\n".join(out.done()).replace("\xa0", " ")


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text) for each row; null ids stay, repeated rows give a row each, other columns are not read. A null page is
    an empty one, pages of any length are read whole, and an empty table gives an empty result."""

    def rows(found):
        for batch in sliced(found, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([visible_text(h) for h in batch.column(1).to_pylist()], pa.string())], names=[id_col, "text"])

    picked = pages.select(pages[id_col].alias(id_col), pages[html_col].alias("html"))
    return picked.mapInArrow(rows, f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, text string")
