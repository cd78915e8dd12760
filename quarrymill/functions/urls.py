"""URL functions as built-in expressions."""

from __future__ import annotations

import ast

from pyspark.sql import Column
from pyspark.sql import functions as F

# What crawling leaves out (fixed values).
FILES = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".zip", ".rar", ".jpg", ".jpeg", ".png", ".gif", ".mp4", ".mp3", ".exe")
PERSON_FILES = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".zip", ".jpg", ".png")
OTHER_SITES = ("weibo.com", "twitter.com", "facebook.com", "linkedin.com", "instagram.com", "youtube.com")
OTHER_PATHS = (
    "/students", "/faculty-staff", "/visitors", "/parents", "/about-us", "/governing-board", "/university-officers", "/news-events",
    "/article-search", "/event-search", "/media", "/academics", "/research", "/research-news", "/photo", "/clear", "/taxonomy", "/node",
    "/page", "/college", "/event", "/news", "/article",
)
LOCAL_PATHS = (
    "/zh-hans/students", "/zh-hans/faculty", "/zh-hans/visitors", "/zh-hans/parents", "/zh-hans/about", "/zh-hans/news", "/zh-hans/research",
    "/zh-hans/academics", "/zh-hans/media", "/zh-hans/event", "/zh-hans/article", "/zh-hans/taxonomy", "/zh-hans/node", "/zh-hans/page", "/zh-hans/college",
)
OTHER_TEXTS = ("更多", "more", "查看", "view", "详情", "detail", "链接", "link", "首页", "home", "返回", "back", "上一页", "下一页", "next", "prev", "搜索", "search", "登录", "login", "注册", "register")
PERSON_PATHS = ("teacher", "faculty", "professor", "people", "staff")


def _any(c: Column, parts, how: str) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | getattr(c, how)(p)
    return out


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda x: x != "")


def normalised(url: Column, base: Column | None = None) -> Column:
    """Without fragment and without slashes at the end; the base's own slash stays. The query stays."""
    whole = F.regexp_replace(url, r"(?s)#.*\z", "")
    cut = F.regexp_replace(whole, r"/+\z", "")
    return cut if base is None else F.when(whole == F.concat(base, F.lit("/")), whole).otherwise(cut)


def relative_depth(url: Column, base: Column) -> Column:
    """Path segments beyond those of the base; 0 at least."""
    return F.greatest(F.size(segments(url)) - F.size(segments(base)), F.lit(0)).cast("long")


def slug(url: Column) -> Column:
    """Host and path joined by underscores."""
    return F.concat_ws("_", F.replace(F.lower(host(url)), F.lit("."), F.lit("_")), F.array_join(segments(url), "_"))


def slug_of_site(url: Column) -> Column:
    return F.regexp_replace(slug(url), r"_\z", "")


def safe_filename(url: Column, extension: str = ".html") -> Column:
    """The path with underscores for anything but word characters, dots and hyphens; index without a path."""
    name = F.regexp_replace(F.array_join(segments(url), "_"), r"[^\p{L}\p{N}_\-.]", "_")
    name = F.when(name == "", "index").otherwise(name)
    return F.when(name.endswith(extension), name).otherwise(F.concat(name, F.lit(extension)))


def bare(url: Column) -> Column:
    """Without query and fragment."""
    return F.regexp_extract(url, r"^[^?#]*", 0)


def crawlable(url: Column, hosts: list[str] | Column) -> Column:
    """On an allowed host, no file to download, and not below /en or /event. ``hosts``: names, or whether the host is one."""
    p = F.lower(path(url))
    listed = hosts if isinstance(hosts, Column) else host(url).isin(hosts)
    return listed & ~_any(F.lower(url), FILES, "endswith") & ~p.rlike(r"^/(en|event)(/|\z)")


def person_link(url: Column, text: Column, other_sites: tuple[str, ...] = ()) -> Column:
    """Whether a link from a list of people leads to one person's page: rules in order, the first decides."""
    p, low, words = F.lower(path(url)), F.lower(url), F.coalesce(text, F.lit(""))
    slashes = F.regexp_count(p, F.lit("/"))
    listing = p.contains("search") | p.contains("list")
    ideographs = F.regexp_count(words, F.lit(r"[\x{4e00}-\x{9fff}]"))
    name = (ideographs.between(2, 4) & (F.length(words) <= 6)) | words.rlike(r"^([A-Z][a-z]+(\s+[A-Z][a-z]+)+|[A-Z][a-z]+\.[A-Z][a-z]+|[A-Z][a-z]{2,20})\z")
    return (
        F.when(_any(F.lower(host(url)), (*OTHER_SITES, *other_sites), "contains"), False)
        .when(url.contains("page=") | url.contains("aggregate-search-teacher"), False)
        .when(_any(low, ("javascript", "mailto:", "tel:", "#"), "contains") | _any(low, PERSON_FILES, "endswith"), False)
        .when(_any(p, OTHER_PATHS, "startswith"), False)
        .when(p.isin("", "/") | ((slashes == 1) & p.endswith("/")) | _any(p, LOCAL_PATHS, "startswith"), False)
        .when((words == "") | (F.length(words) > 50) | F.lower(words).isin(*OTHER_TEXTS), False)
        .when(name & (slashes >= 2) & ~listing, True)
        .otherwise(_any(p, PERSON_PATHS, "contains") & ~listing)
    )


def seeds(given: str | list[str]) -> list[str]:
    """Start URLs from a list, a list as text, or one URL; slashes at the end go, and so do repeats."""
    if isinstance(given, str):
        try:
            read = ast.literal_eval(given)
        except (ValueError, SyntaxError):
            read = given
        given = [read] if isinstance(read, str) else list(read)
    return list(dict.fromkeys(s for g in given if (s := g.strip().rstrip("/"))))
