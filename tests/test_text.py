"""The quirks of the text rules on literal rows."""

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.functions import urls as U
from quarrymill.operators import quality as Q


@pytest.fixture(scope="module")
def value(spark):
    def of(make, *given):
        df = spark.createDataFrame([tuple(given)], [f"c{k}" for k in range(len(given))] if all(g is not None for g in given) else ", ".join(f"c{k} string" for k in range(len(given))))
        return df.select(make(*(F.col(c) for c in df.columns)).alias("v")).first().v

    return of


def test_white_space_is_unicode(value):
    odd = "　a\xa0b\x85c\x1cd\n"
    assert value(T.compact, odd) == "abcd" and value(T.squeeze, odd) == "a b c d"
    assert value(T.strip, odd) == "a\xa0b\x85c\x1cd" and value(T.words, odd) == 4


def test_runs_and_density(value):
    assert value(T.script_runs, "课程CSC3100介绍 a a 12") == 7
    assert value(T.density, "课程CSC3100介绍 a a 12") == 6


def test_lines_that_repeat(value):
    assert value(Q.page_cleaned, "aa\naa\naa\nb\naa") == "aa\naa\nb\naa"
    assert value(Q.page_cleaned, "twelve chars\nx\ntwelve chars") == "twelve chars\nx"
    assert value(Q.person_cleaned, "eleven char\nx\neleven char") == "eleven char\nx\neleven char"
    assert value(Q.person_cleaned, "twelve chars\nx\ntwelve chars") == "twelve chars\nx"
    assert value(Q.page_cleaned, "a  b� 登录 | 注册 CN|EN\n页面 12\n\n\n\nMenu c 返回\nd") == "a b\nc\nd"


def test_truncation(value):
    assert value(lambda c: T.truncated(c, 2800), "x" * 2800) == "x" * 2800
    assert value(lambda c: T.truncated(c, 2800), "x" * 2801) == "x" * 2800 + T.CUT


def test_mostly_english_is_strict(value):
    assert value(T.mostly_english, "abcdefg一二三") is False
    assert value(T.mostly_english, "abcdefgh一二三") is True
    assert value(T.mostly_english, "123") is False


@pytest.mark.parametrize("given, want", [("```json\n{}\n```", "{}"), ("```\n{}\n```", "```\n{}"), (" {} ", "{}"), ("```json {\n}\n```", "}")])
def test_fences(value, given, want):
    assert value(T.fences_stripped, given) == want


@pytest.mark.parametrize("given, want", [('"A title"', "A title"), ("skip", None), ("SKIP: why", None), ("t" * 101, "t" * 100 + "..."), ("Skipping", "Skipping")])
def test_page_titles(value, given, want):
    assert value(lambda c: T.title(c, 100), given) == want


def test_person_titles(value):
    assert value(lambda c: T.title(c, 80, 2), "x") is None and value(lambda c: T.title(c, 80, 2), "xy") == "xy"


def repaired(text):
    if len(text) < 10 or not any(ord(c) > 127 and not 0x4E00 <= ord(c) <= 0x9FFF and not 0x3400 <= ord(c) <= 0x4DBF for c in text[:100]):
        return text
    fixed = text.encode("latin1", errors="ignore").decode("utf-8", errors="ignore")
    return fixed if fixed and len(fixed) > len(text) * 0.5 else text


@pytest.mark.parametrize("text", ["中文标题很长的一段文字".encode().decode("latin1"), "café au lait encore", "short é", "plain text here", "中文中文中文中文中文é abc", "é" * 30])
def test_mojibake(value, text):
    assert value(T.mojibake_repaired, text) == repaired(text)


def test_controls(value):
    assert value(T.without_controls, "a\x00b\tc\x7fd\n\x9f") == "ab\tcd\n"


def test_pdf_text(value):
    assert value(T.pdf_cleaned, " a\xa0\t b\n\n\n\nc ") == "a b\n\nc"


def test_thresholds_are_inclusive(value):
    rules = Q.CleanRules(least=1)
    assert value(lambda c: Q.acceptable(c, rules), "a" * 17 + "一" * 3) is False  # ASCII share 0.85
    assert value(lambda c: Q.acceptable(c, rules), "a" * 16 + "一" * 4) is True
    assert value(lambda c: Q.acceptable(c, rules), "3" * 6 + "一" * 14) is False  # digit share 0.30
    assert value(lambda c: Q.acceptable(c, rules), "²" * 6 + "一" * 14) is False
    assert value(lambda c: Q.acceptable(c), "一" * 119) is False and value(lambda c: Q.acceptable(c), "一" * 120) is True


def test_navigation_page(value):
    tokens = "".join(Q.NAV_TOKENS[:5])
    assert value(Q.nav_page, tokens.ljust(999, "x")) is True and value(Q.nav_page, tokens.ljust(1000, "x")) is False


@pytest.mark.parametrize(
    "text, reason",
    [
        ("x", "short"), ("一" * 200, None), ("word " * 40 + "An Actor", "pattern"), ("\n".join(["a" * 10, "b" * 10, "c" * 10] * 4)[:-11], "repeated"),
        ("\n".join(["abcdefghijkl"] * 10), None), ("- item one here\n" * 10, "list"), ("�" * 10 + "字" * 150, "broken"),
        ("返回主站" * 30, "navigation"), ("".join(Q.PAGE_CATEGORIES).ljust(200, "字"), "menu"),
    ],
)
def test_page_reasons(value, text, reason):
    assert value(Q.page_reason, text) == reason


@pytest.mark.parametrize("text, reason", [("  ", "empty"), ("x" * 79, "short"), ("x" * 80, None), ("\n".join(["line of text a", "line of text b"] * 5), "repeated")])
def test_person_reasons(value, text, reason):
    assert value(Q.person_reason, text) == reason


def test_descriptions_come_first(value):
    assert value(Q.with_description, "body", " meta ") == "meta\n\nbody" and value(Q.with_description, "body", " ") == "body"


def test_minimal_page(value):
    text = "a\nb\nc"
    assert value(lambda c: Q.minimal_page(c, F.lit(14)), text) is True and value(lambda c: Q.minimal_page(c, F.lit(29)), text) is True
    assert value(lambda c: Q.minimal_page(c, F.lit(30)), text) is False and value(lambda c: Q.minimal_page(c, F.lit(15)), text + " Research") is False


def test_overcleaned_text_falls_back(value):
    assert value(Q.kept_content, "a long original text, of some length", "short") == "a long original text, of some length"
    assert value(Q.kept_content, "tiny", "tiny") is None


def test_urls(value):
    assert value(lambda u: U.normalised(u, F.lit("http://b")), "http://b/x//#f") == "http://b/x"
    assert value(lambda u: U.normalised(u, F.lit("http://b")), "http://b/") == "http://b/"
    assert value(lambda u: U.relative_depth(u, F.lit("http://b/a/c")), "http://b/x") == 0
    assert value(U.slug_of_site, "https://Www.A.org/x/y/") == "www_a_org_x_y" and value(U.slug_of_site, "https://a.org") == "a_org"
    assert value(U.bare, "http://a/b?c#d") == "http://a/b" and value(U.safe_filename, "http://a/") == "index.html"
    assert value(lambda u: U.crawlable(u, ["a.org"]), "http://a.org/x") is True
    for bad in ("http://b.org/x", "http://a.org/x.PDF", "http://a.org/en", "http://a.org/event/1"):
        assert value(lambda u: U.crawlable(u, ["a.org"]), bad) is False
    assert value(lambda u: U.crawlable(u, ["a.org"]), "http://a.org/energy") is True
    assert U.seeds("['http://a/', 'http://b', 'http://a']") == ["http://a", "http://b"] and U.seeds("http://a/") == ["http://a"]


@pytest.mark.parametrize(
    "url, text, want",
    [
        ("http://a.org/zh/li-ming", "李明", True), ("http://a.org/people/x", "profile page", True), ("http://a.org/li", "李明", False), ("http://weibo.com/a/b", "李明", False),
        ("http://a.org/zh/list?page=2", "李明", False), ("http://a.org/zh/x#y", "李明", False), ("http://a.org/news/x", "John Smith", False), ("http://a.org/zh/js", "John Smith", True),
        ("http://a.org/people/x", "更多", False), ("http://a.org/teacher-list/x", "John Smith", False), ("http://a.org/zh/x", "一二三四五", False), ("http://a.org/zh/x", "", False),
    ],
)
def test_person_links(value, url, text, want):
    assert value(U.person_link, url, text) is want
