import html
import random
import re
import time

import pytest

from quarrymill.llm.html_text import extract_pages, visible_text

CASES = {
    "<p>one<p>two<div>three</div>four": "one\n\ntwo\n\nthree\nfour",
    "<b>a <i>b</b> c</i>": "a b c",
    "<title>t</title><style>x</style><script>var a='</p>';</script>text": "text",
    "<head><title>t</title><body>x": "x",
    "<div hidden>a</div><span style='display: none'>b</span>c": "c",
    "<p style='visibility:hidden'>a<b style='visibility:visible'>b</b></p>": "b",
    "<details><summary>s</summary>more</details><details open><summary>s</summary>more</details>": "s\ns\nmore",
    "<ul><li>a<li>b<ol start=3><li>x<li value=7>y</ol></ul>end": "- a\n- b\n  3. x\n  7. y\n\nend",
    "<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>b<td>22</table>": "name       n\nlong name  1\nb          22",
    "<table><tr><td colspan=2>wide cell<td>c<tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e</table>": "wide cell  c\na  b  c\n   d  e",
    "<table><td>no row</table>": "no row",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<pre>\n x\n  y </pre>": " x\n  y",
    "<blockquote>q<br>r</blockquote>": "  q\n  r",
    "a &amp; b&nbsp;c &lt;d&gt; &#233;": "a & b c <d> é",
    "  many \n\t spaces  ": "many spaces",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "plain <!-- no --> text": "plain text",
    "x<p></p></p>y": "x\n\ny",
    "": "",
}


@pytest.mark.parametrize("page", CASES)
def test_layout(page):
    assert visible_text(page) == CASES[page]


def brute(page):
    """The words left when all that isn't shown and then all tags are cut out."""
    page = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<(script|style)>.*?</\1>", " ", page)
    return html.unescape(re.sub(r"<[^>]*>", " ", page)).split()


def test_all_visible_words_in_order(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    for r in pages.collect():
        assert [w for w in got[r.page_id].split() if w != "-"] == [w for w in brute(r.html) if w != "-"]


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    long = "<p>" + "word " * 200_000
    rows = [(1, None), (2, ""), (3, deep), (4, long), (None, "<p>x"), (1, None), (5, "<table>" * 300 + "<td>" * 300 + "in"), (6, "<a <b c"), (7, "<ul>" * 300 + "<li>z")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, html string, text string")
    got = sorted((str(r.page_id), r.text) for r in extract_pages(pages).collect())
    assert len(got) == len(rows) and dict(got)["3"] == "deep" and dict(got)["4"].split() == ["word"] * 200_000
    assert "in" in dict(got)["5"] and dict(got)["None"] == "x" and dict(got)["7"].endswith("z")
    assert extract_pages(pages.limit(0)).collect() == []


def test_formulas_and_drawings():
    page = "so <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></semantics></math> holds <annotation>here</annotation>"
    assert visible_text(page) == "so x=2 holds here"
    page = "<svg><title>t</title><desc>d</desc><defs/><defs><text>no</text></defs><rect/><g><text>one</text><text>two <tspan>three</tspan></text></g></svg>end"
    assert visible_text(page) == "one two three end"


def test_hidden_text_stays_hidden_at_any_depth():
    for depth in (10, 149, 1000, 20_000):
        assert visible_text("<div>" * depth + "<div hidden><span>secret</span></div>seen") == "seen"


@pytest.mark.parametrize(
    "html",
    ["<table>" + "<tr><td rowspan=60000 colspan=1000>a</td></tr>" * 2000 + "</table>", "<span>" * 100_000 + "x", "<p>" + "<span>" * 30_000 + "<div>" * 30_000 + "x", "<ul><li>" * 3000 + "x",
     "<table><tr><td>" * 3000 + "x", "a" * 1_000_000, " " * 1_000_000, "<" * 200_000, "&" * 200_000, "<li>" * 50_000],
)
def test_hard_pages_take_no_longer_than_their_length(html):
    began = time.time()
    visible_text(html)
    assert time.time() - began < 5


def test_row_spans_move_later_cells():
    rows = "<tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr><tr><td>e</td></tr>"
    assert visible_text(f"<table>{rows}</table>").split("\n") == ["a  b", "   c  d", "e"]


def random_page(rng, depth=0):
    """(html, the same as text with marks: 1 for a line's end, 2 for a blank line) of nested blocks, spans and hidden
    parts. Paragraphs have no blocks in them, which would end them."""
    out_html, out_text = "", ""
    for _ in range(rng.randrange(1, 4)):
        kind = rng.choice(("text", "text", "div", "p", "span", "hidden", "br", "comment"))
        if kind == "text" or depth > 4:
            words = rng.choice((" one two ", "three", " four\n five", "x", " "))
            out_html, out_text = out_html + words, out_text + words
        elif kind == "p":
            words = rng.choice(("para one", " para  two ", ""))
            out_html, out_text = out_html + f"<p>{words}</p>", out_text + f"\2{words}\2"
        elif kind == "br":
            out_html, out_text = out_html + "y<br>z", out_text + "y\1z"
        elif kind == "comment":
            out_html += "<!-- not seen <p> -->"
        else:
            inner_html, inner_text = random_page(rng, depth + 1)
            if kind == "div":
                out_html, out_text = out_html + f"<div class='a'>{inner_html}</div>", out_text + f"\1{inner_text}\1"
            elif kind == "span":
                out_html, out_text = out_html + f"<span>{inner_html}</span>", out_text + inner_text
            else:
                out_html += rng.choice(("<div hidden>{}</div>", "<div style='display:none'>{}</div>", "<noscript>{}</noscript>")).format(inner_html)
    return out_html, out_text


def test_random_pages_against_marks_in_a_string():
    rng = random.Random(3)
    for _ in range(2000):
        page, marked = random_page(rng)
        # Lines, then blank lines where a paragraph ends or begins, each once.
        want = re.sub(r"[ \n]+", " ", marked)
        want = re.sub(r" ?([\1\2])[ \1\2]*", lambda m: "\n\n" if "\2" in m[0] else "\n", want)
        assert visible_text(page) == want.strip(" \n"), page
