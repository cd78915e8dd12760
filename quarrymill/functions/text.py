"""Text functions, string column to string column, as built-in expressions: all but ``converted`` stay in the JVM.

White space is the Unicode set, digits and letters likewise; regular expressions spell the set out, since engines
disagree on ``\\s``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE, NOT_SPACE = f"[{_SPACES}]", f"[^{_SPACES}]"
#: The same characters one by one.
SPACE_CHARACTERS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Runs of CJK ideographs, of Latin letters, or of digits.
SCRIPT_RUN = r"[\x{4e00}-\x{9fff}]+|[a-zA-Z]+|\p{Nd}+"
#: Digits, and the superscript, subscript and circled ones that count as digits though they aren't decimal.
DIGIT = r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"

#: Markers of cut texts (fixed values).
CUT, CHAT_CUT = "……（内容已截断）", "\n\n[内容已截断...]"


def text(c: Column | str) -> Column:
    """A column with null as the empty string."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def blank(c: Column) -> Column:
    """True for null and empty strings."""
    return F.coalesce(c, F.lit("")) == ""


def let(value: Column, body) -> Column:
    """``body`` of a value that is made once. A plain expression that is used several times is made as often; here it
    is the variable of a lambda over an array of one."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space at the ends, in time that grows with their length alone."""
    return F.btrim(c, F.lit(SPACE_CHARACTERS))


def compact(c: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(c, f"{SPACE}+", "")


def squeeze(c: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, f"{SPACE}+", " "))


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def occurrences(c: Column, part: str) -> Column:
    """How often ``part`` occurs, without overlaps."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / len(part)).cast("long")


def hits(c: Column, parts) -> Column:
    """How many of ``parts`` occur."""
    total = F.lit(0)
    for p in parts:
        total = total + c.contains(p).cast("int")
    return total


def words(c: Column) -> Column:
    """Number of words between white space."""
    return count(c, f"{NOT_SPACE}+")


def script_runs(c: Column) -> Column:
    return count(c, SCRIPT_RUN)


def has_any(c: Column, parts) -> Column:
    """Whether any of ``parts`` occurs; it ends with the first one found."""

    def found(x: Column) -> Column:
        out = F.lit(False)
        for p in parts:
            out = out | x.contains(p)
        return out

    return let(c, found)


def density(c: Column) -> Column:
    """Number of distinct script runs."""
    return F.size(F.array_distinct(F.regexp_extract_all(c, F.lit(SCRIPT_RUN), F.lit(0)))).cast("long")


def share(c: Column, pattern: str) -> Column:
    """The share of characters that match; 0 for an empty text. ``c`` is used three times."""
    return F.when(F.length(c) == 0, 0.0).otherwise(count(c, pattern) / F.length(c))


def lines(c: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")


def first_of_long(items: Column, least: int) -> Column:
    """Without later copies of strings of ``least`` characters and more. Shorter ones carry their place in the key, so
    that one linear array_distinct does it."""
    keyed = F.transform(items, lambda x, i: F.concat(F.when(F.length(x) < least, F.lpad(i.cast("string"), 10, "0")).otherwise(F.lit("x" * 10)), x))
    return F.transform(F.array_distinct(keyed), lambda x: F.substr(x, F.lit(11)))


def no_third_repeat(items: Column) -> Column:
    """Of a run of equal strings the first two."""
    return let(items, lambda a: F.filter(a, lambda x, i: ~((i >= 2) & (x == F.get(a, i - 1)) & (x == F.get(a, i - 2)))))


def cleaned(c: Column, patterns, least: int, runs: bool) -> Column:
    """Without replacement characters, navigation ``patterns`` and repeated lines of ``least`` characters and more;
    ``runs``: also without the third and later of equal lines in a row."""
    out = F.replace(c, F.lit("�"), F.lit(""))
    for p in patterns:
        out = F.regexp_replace(out, f"(?imd){p}", "")
    kept = lines(F.regexp_replace(out, r"\n{3,}", "\n\n"))
    kept = first_of_long(no_third_repeat(kept) if runs else kept, least)
    return strip(F.regexp_replace(F.array_join(kept, "\n"), " {2,}", " "))


def pdf_cleaned(c: Column) -> Column:
    out = F.regexp_replace(F.replace(c, F.lit("\xa0"), F.lit(" ")), r"[ \t]+", " ")
    return strip(F.regexp_replace(out, r"\n{2,}", "\n\n"))


def without_controls(c: Column) -> Column:
    """Without control characters but tab, line feed and carriage return."""
    return F.regexp_replace(c, CONTROL, "")


def mojibake_repaired(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, read again. Texts of 10 characters and more, with one above 127 that isn't an
    ideograph among their first 100, are encoded as Latin-1 and decoded as UTF-8, both without what doesn't fit; the
    result counts if it has more than half of the length."""
    odd = F.substring(c, 1, 100).rlike(r"[^\x00-\x7f\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]")
    raw = F.encode(F.regexp_replace(c, r"[^\x00-\xff]", ""), "ISO-8859-1")
    fixed = F.replace(F.make_valid_utf8(raw.cast("string")), F.lit("�"), F.lit(""))
    return F.when((F.length(c) >= 10) & odd & (F.length(fixed) > F.length(c) * 0.5), fixed).otherwise(c)


def truncated(c: Column, most: int, marker: str = CUT) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit(marker))).otherwise(c)


def head(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def tail(c: Column, n: int) -> Column:
    """What follows the first n characters."""
    return F.substr(c, F.lit(n + 1))


def mostly_english(c: Column) -> Column:
    """Latin letters are over 0.7 of Latin letters and ideographs."""
    latin, cjk = count(c, "[a-zA-Z]"), count(c, r"[\x{4e00}-\x{9fff}]")
    return F.coalesce(F.when(latin > 0, latin / (latin + cjk) > 0.7), F.lit(False))


def fences_stripped(c: Column) -> Column:
    """Without a Markdown code fence: an opening line goes if ``json`` follows its backticks, and a closing one always."""
    body = strip(c)
    opened = F.regexp_replace(body, r"\A`*json[^\n]*(\n|\z)", "")
    closed = F.regexp_replace(opened, r"(\A|\n)[\t\x0b\x0c\r ]*```[^\n]*\z", "")
    return F.when(body.startswith("```"), strip(closed)).otherwise(body)


def title(c: Column, most: int, least: int = 0) -> Column:
    """A model's title: without quotes around it, null if it begins with SKIP, is skip in any case or is shorter than
    ``least``; cut after ``most``."""
    bare = strip(F.regexp_replace(strip(c), r"\A[\"']+|[\"']+\z", ""))
    good = (F.length(bare) >= least) & (F.upper(bare) != "SKIP") & ~bare.startswith("SKIP")
    return F.when(good, truncated(bare, most, "..."))


def tokens_estimated(c: Column, characters: int) -> Column:
    return F.floor(F.length(c) / characters)


def emails(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(EMAIL), F.lit(0))


def converted(c: Column, convert: Callable[[str], str]) -> Column:
    """A column put through a function of strings, such as one that turns traditional into simplified script; nulls
    stay. It is the one function here that leaves the JVM, in Arrow batches."""

    @F.pandas_udf("string")
    def each(values: pd.Series) -> pd.Series:
        return values.map(convert, na_action="ignore")

    return each(c)
