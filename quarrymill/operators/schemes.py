"""Study schemes: structure out of page texts and tables, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions import text as T

# Patterns and words of the documents (fixed values).
CODE = r"(?<![\p{L}\p{N}_])([A-Z]{2,4}[0-9]{4}[A-Z]?)(?![\p{L}\p{N}_])"
WHOLE_CODE = r"^[A-Z]{2,4}[0-9]{4}[A-Z]?\z"
UNITS = (r"(?i)(?:Units|學分)[:\s]*(\d+)", r"(?i)(\d+)\s*(?:units|學分)", r"共[:\s]*(\d+)", r"(?i)Total[:\s]*(\d+)")
TOTAL = (r"(?i)(?:Total|共|总计)[:\s]*(\d+)", r"(?i)(\d+)\s*(?:units|学分)\s*(?:total|总计|共)")
PARTS = {
    "school_package_units": (r"(?i)(?:School Package|学院课程)[:\s]*(\d+)", r"(?i)(\d+)\s*(?:units|学分).*?(?:School Package|学院课程)"),
    "required_units": (r"(?i)(?:Required Courses|必修科目|必修课程)[:\s]*(\d+)", r"(?i)(\d+)\s*(?:units|学分).*?(?:Required|必修)"),
    "elective_units": (r"(?i)(?:Elective Courses|选修科目|选修课程)[:\s]*(\d+)", r"(?i)(\d+)\s*(?:units|学分).*?(?:Elective|选修)"),
}
TITLES = (r"(?i)(?:Programme Title|Minor Programme Title|Major Programme Title)[:\s]*([^\n]+)", r"(?:课程名称|副修课程名称|主修课程名称)[:\s]*([^\n]+)")
YEARS = (r"(?i)Applicable to students admitted in ([^\n]+)", r"适用于([^\n]+?)(?:入学|年度|学生)")
MINOR, DOUBLE = r"(?i)Minor Programme|副修", r"(?i)Double Major|双主修"
SECTIONS = {
    "school_package": (r"(?is)(?:School Package|学院课程)[:\s]*([^2-3]+?)(?=\d+\.\s*(?:Required|必修|Elective|选修))", r"(?is)1\.\s*(?:School Package|学院课程)[:\s]*([^2]+?)(?=2\.)"),
    "required": (r"(?is)(?:Required Courses|必修科目|必修课程)[:\s]*([^3]+?)(?=\d+\.\s*(?:Elective|选修)|Total|共|Notes|注)", r"(?is)2\.\s*(?:Required Courses|必修科目|必修课程)[:\s]*([^3]+?)(?=3\.)"),
    "elective": (r"(?is)(?:Elective Courses|选修科目|选修课程)[:\s]*([^N]+?)(?=Notes|注|Total|共|Explanatory)", r"(?is)3\.\s*(?:Elective Courses|选修科目|选修课程)[:\s]*([^N]+?)(?=Notes|注|Total|共)"),
}
NOTES = (r"(?isd)(?:Notes|注)[:\s]*\n(.*?)(?=\n\n|\n[A-Z]|\z)", r"(?isd)Explanatory Notes[:\s]*\n(.*?)(?=\n\n|\z)")
NOTE = r"(?i)\[([a-z])\]\s*([^\n]+)"
STREAM_NAMES = (
    r"(?imd)(?:^|\n)\s*(i{1,5}\)|v\))\s+([A-Z][A-Za-z\s]{3,40}?Stream)", r"(?md)(?:^|\n)\s*(i{1,5}\)|v\))\s+([^：:\n()]{2,15}?)(?:方向|专修范围)",
    r"(?md)\((\d+)\)\s+([A-Z][A-Za-z\s]{3,40}?)(?:;|and|$)", r"(?md)（(\d+)）\s+([^：:\n()]{2,20}?)(?:；|;|及|and|$)",
)
STREAM_INTRO = (
    r"(?is)(?:are divided into|分设).*?(?:streams|专修范围|stream).*?[：:]\s*([^A-Z会计学]+?)(?=\n[A-Z]|Accounting|会计|Students|学生|Total|共|Elective|选修)",
    r"(?is)(?:Studies in|本课程).*?(?:divided into|分设).*?(?:streams|专修范围).*?[：:]\s*([^A-Z会计学]+?)(?=\n[A-Z]|Accounting|会计|Students|学生)",
    r"(?is)(?:specialize in one of the|选修其中一项).*?[：:]\s*([^A-Z会计学]+?)(?=\n[A-Z]|Accounting|会计|Students|学生)",
)
STREAM_PARAGRAPH = r"(?ismd)(?:^|\n).*?(?:stream|方向|专修范围).*?[：:]\s*([^\n]{50,500}?)(?=\n\n|\n[A-Z]{3,})"
NO_STREAM = (
    "year of attendance", "attendance", "core requirements", "major requirements", "university core", "medical core", "first year", "second year",
    "third year", "fourth year", "fifth year", "sixth year", "年级", "年度", "要求", "核心", "必修要求", "核心课程", "university requirements",
)
HEADERS = ("Course Code", "课程代码", "代码", "Code", "Course")
IDEOGRAPH = r"[\x{4e00}-\x{9fff}]"


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without one."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def codes(c: Column) -> Column:
    """Distinct course codes in order of the alphabet."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(CODE), F.lit(1))))


def level(code: Column) -> Column:
    """The first digit of a code's number, in thousands."""
    return found(code, r"^[A-Z]+([0-9])[0-9]{3}").cast("int") * 1000


def units(c: Column) -> Column:
    return F.coalesce(*(found(c, p).cast("int") for p in UNITS))


def requirements(c: Column) -> Column:
    """total_units by the first pattern that matches; the other units by the last one."""
    parts = [F.coalesce(*(found(c, p).cast("int") for p in reversed(patterns))).alias(k) for k, patterns in PARTS.items()]
    return F.struct(F.coalesce(*(found(c, p).cast("int") for p in TOTAL)).alias("total_units"), *parts)


def programme(c: Column) -> Column:
    """Names, years and type. A title with an ideograph is the Chinese name; the first title of a language counts."""
    names = [F.regexp_replace(T.strip(found(c, p)), r"\s+", " ") for p in TITLES]
    zh = F.coalesce(*(F.when(n.rlike(IDEOGRAPH), n) for n in names))
    en = F.coalesce(*(F.when(~n.rlike(IDEOGRAPH), n) for n in names))
    years = F.regexp_replace(T.strip(F.coalesce(*(found(c, p) for p in YEARS))), r"\s+", " ")
    kind = F.when(c.rlike(MINOR), "minor").when(c.rlike(DOUBLE), "double_major").otherwise("major")
    return F.struct(en.alias("programme_name_en"), zh.alias("programme_name_zh"), years.alias("applicable_years"), kind.alias("programme_type"))


def section(c: Column, name: str) -> Column:
    """The text of a section by the first of its patterns that matches."""
    return F.coalesce(*(found(c, p) for p in SECTIONS[name]))


def section_courses(c: Column, name: str) -> Column:
    """The courses of a section: (code, level, course_type)."""
    return F.transform(codes(T.text(section(c, name))), lambda x: F.struct(x.alias("code"), level(x).alias("level"), F.lit(name).alias("course_type")))


def notes(c: Column) -> Column:
    """Items ``[x] text`` of the notes, of 6 to 499 characters."""
    body = T.text(F.coalesce(*(found(c, p) for p in NOTES)))
    marks, texts = (F.regexp_extract_all(body, F.lit(NOTE), F.lit(k)) for k in (1, 2))
    items = F.zip_with(marks, texts, lambda m, t: F.struct(m.alias("m"), T.strip(t).alias("t")))
    return F.transform(F.filter(items, lambda x: (F.length(x.t) > 5) & (F.length(x.t) < 500)), lambda x: F.concat(F.lit("["), x.m, F.lit("] "), x.t))


def _streams_in(c: Column, across_lines: bool = False) -> Column:
    squeezed = lambda x: F.regexp_replace(T.strip(x), r"\s+", " ")
    flag = "(?s)" if across_lines else ""
    names = [F.transform(F.regexp_extract_all(c, F.lit(flag + p), F.lit(2)), squeezed) for p in STREAM_NAMES]
    names[2] = F.transform(names[2], lambda x: T.strip(F.regexp_replace(x, r"(?i)[;\s]+(and|及)\z", "")))
    names[3] = F.transform(names[3], lambda x: T.strip(F.regexp_replace(x, r"[；;\s]+(及|and)\z", "")))
    several = lambda x: T.words(x).between(2, 6)
    chinese = lambda x: x.rlike(IDEOGRAPH) & F.length(x).between(2, 15)
    none = F.lit(None).cast("string")
    en = lambda x: F.struct(x.alias("name_en"), none.alias("name_zh"))
    zh = lambda x: F.struct(none.alias("name_en"), x.alias("name_zh"))
    return F.array_distinct(
        F.concat(
            F.transform(F.filter(names[0], lambda x: several(F.replace(x, F.lit("Stream"), F.lit("")))), en),
            F.transform(F.filter(names[1], chinese), zh), F.transform(F.filter(names[2], several), en), F.transform(F.filter(names[3], chinese), zh),
        )
    )


def streams(c: Column) -> Column:
    """Distinct (name_en, name_zh) from the introduction, else the electives, else a paragraph on streams, else all."""
    intro = [found(c, p) for p in STREAM_INTRO]
    introduction = F.coalesce(*(F.when(F.length(x) < 500, x) for x in intro), *reversed(intro))
    place = F.coalesce(introduction, found(c, SECTIONS["elective"][0]), found(c, STREAM_PARAGRAPH), c)
    name = lambda s: F.lower(F.concat(T.text(s.name_en), F.lit(" "), T.text(s.name_zh)))
    return F.filter(_streams_in(place), lambda s: T.hits(name(s), NO_STREAM) == 0)


def table_text(tables: Column) -> Column:
    return F.array_join(F.transform(F.flatten(tables), lambda r: F.array_join(r, " ", "")), "\n")


def streams_of(c: Column, tables: Column) -> Column:
    """Streams of the text, else of the tables, else of both, else of both across lines, else of single cells."""
    of_tables = table_text(tables)
    both = F.concat(c, F.lit("\n"), of_tables)
    cells = F.array_distinct(F.flatten(F.transform(F.filter(F.flatten(F.flatten(tables)), lambda x: x.isNotNull()), lambda x: _streams_in(x, True))))
    tries = [streams(c), streams(of_tables), streams(both), _streams_in(both, True)]
    out = cells
    for t in reversed(tries):
        out = F.when(F.size(t) > 0, t).otherwise(out)
    return out


def table_courses(tables: DataFrame) -> DataFrame:
    """One row per course of a table (rows): code, name_en, name_zh, units, level, row_no, with the other columns.

    Columns are found by words of the header; a code column may be the first one by its look. Cells of code columns
    count without white space, and rows without a valid code go.
    """
    is_code = lambda x: x.contains("code") | x.contains("課程代碼") | x.contains("代碼")
    is_en = lambda x: ~is_code(x) & x.contains("title") & x.contains("english")
    is_zh = lambda x: ~is_code(x) & ~is_en(x) & ((x.contains("title") & x.contains("chinese")) | x.contains("中文") | x.contains("課程名稱"))
    is_units = lambda x: ~is_code(x) & ~is_en(x) & ~is_zh(x) & (x.contains("unit") | x.contains("學分") | x.contains("学分"))
    header = F.get("rows", F.lit(0))
    last = lambda test: F.get(F.slice(F.reverse(F.filter(F.transform(header, lambda x, i: F.when(test(F.lower(T.text(x))), i)), lambda i: i.isNotNull())), 1, 1), F.lit(0))
    rest = [c for c in tables.columns if c != "rows"]
    cell = lambda at: T.strip(F.get(F.col("_row"), F.col(at)))
    code = F.when(F.col("_code").isNotNull() & (F.col("_code") < F.size("_row")), cell("_code")).otherwise(found(T.text(F.get(F.col("_row"), F.lit(0))), CODE))
    some = lambda c: F.when(c != "", c)
    rows = (
        tables.where(F.size("rows") > 1)
        .select(
            *rest, F.coalesce(last(is_code), F.when(T.strip(T.text(F.get(header, F.lit(0)))).rlike(r"^[A-Z]{2,4}[0-9]{4}"), F.lit(0))).alias("_code"),
            last(is_en).alias("_en"), last(is_zh).alias("_zh"), last(is_units).alias("_units"), F.posexplode(F.slice("rows", 2, F.size("rows"))).alias("row_no", "_row"),
        )
        .withColumn("code", F.regexp_replace(code, f"{T.SPACE}+", ""))
    )
    return rows.where(F.col("code").rlike(WHOLE_CODE)).select(
        *rest, "row_no", "code", some(cell("_en")).alias("name_en"), some(cell("_zh")).alias("name_zh"), found(cell("_units"), r"([0-9]+)").cast("int").alias("units"), level(F.col("code")).alias("level")
    )


def merged_courses(listed: DataFrame, tabled: DataFrame) -> DataFrame:
    """Courses of the sections filled from those of the tables; courses of tables alone become electives.

    ``listed``: (scheme, code, list_no, course_type, name_en, name_zh, units, level); ``tabled``: (scheme, code, row_no,
    name_en, name_zh, units, level). The earliest list that has a code is filled, where a field is null, empty or 0,
    with the first value of the tables. One full outer join on (scheme, code).
    """
    fields = ("name_en", "name_zh", "units")
    good = lambda c: F.when((F.col(c) != 0) if c == "units" else (F.col(c) != ""), F.col(c))
    first = tabled.groupBy("scheme", "code").agg(
        *(F.min(F.when(good(c).isNotNull(), F.struct("row_no", F.col(c).alias("v")))).alias(f"_{c}") for c in fields), F.min("level").alias("_level")
    )
    nth = F.row_number().over(Window.partitionBy("scheme", "code").orderBy("list_no"))
    ranked = listed.withColumn("_nth", nth)
    return (
        ranked.join(first.withColumn("_nth", F.lit(1)), ["scheme", "code", "_nth"], "full_outer")
        .select("scheme", "code", F.coalesce("course_type", F.lit("elective")).alias("course_type"), *(F.coalesce(good(c), F.col(f"_{c}.v"), F.col(c)).alias(c) for c in fields), F.coalesce("level", "_level").alias("level"))
    )


def scheme_record(df: DataFrame, text: str = "text") -> DataFrame:
    """One nested record per scheme with empty strings for missing names; raw electives where no stream was found."""
    c = F.col(text)
    info, need = programme(c), requirements(c)
    lists = {k: section_courses(c, k) for k in SECTIONS}
    found_streams = streams(c)
    raw = F.when((F.size(found_streams) == 0) & (F.size(lists["elective"]) > 0), F.substring(section(c, "elective"), 1, 2000))
    return df.withColumn("info", info).withColumn("need", need).select(
        *(x for x in df.columns if x != text), *(T.text(F.col(f"info.{k}")).alias(k) for k in ("programme_name_en", "programme_name_zh", "applicable_years", "programme_type")), "need.*",
        *(v.alias(f"{k}_courses") for k, v in lists.items()), found_streams.alias("streams"), notes(c).alias("notes"), raw.alias("raw_elective_section"),
    )
