"""Record builders: labelled texts, titles and nested output rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import text as T

# Labels and defaults of the records (fixed values).
COURSE_LABELS = {
    "code": "课程代码", "title": "课程名称", "level": "学历层次", "school": "所属学院", "credits": "学分", "grading": "评分方式",
    "teaching_mode": "教学方式", "term": "开课学期", "category": "课程类别",
}
DESCRIPTION, LINK = "课程描述", "课程链接"
NO_COURSE, NO_TITLE, NO_URL = "未知课程", "未知标题", "未知链接"


def labelled(name: str, label: str) -> Column:
    return F.when(~T.blank(F.col(name)), F.concat(F.lit(f"{label}："), F.col(name)))


def course_content(names: dict[str, str] = COURSE_LABELS) -> Column:
    """Labelled lines of the fields that there are, then the description in a paragraph of its own after two blank lines."""
    info = F.concat_ws("\n", *(labelled(k, v) for k, v in names.items()))
    about = F.when(~T.blank(F.col("description")), F.concat(F.lit(f"\n{DESCRIPTION}：\n"), F.col("description")))
    return T.strip(F.concat_ws("\n\n", F.when(info != "", info), about))


def course_content_flat() -> Column:
    """Labelled lines without code and title but with the link, then description and earlier content."""
    names = {k: v for k, v in COURSE_LABELS.items() if k not in ("code", "title")} | {"url": LINK}
    about = F.when(~T.blank(F.col("description")), F.concat(F.lit(f"\n{DESCRIPTION}：\n"), F.col("description")))
    more = F.when(~T.blank(F.col("content")), F.concat(F.lit("\n"), F.col("content")))
    return F.concat_ws("\n", *(labelled(k, v) for k, v in names.items()), about, more)


def course_title(code: Column, title: Column, between: str) -> Column:
    """Code and title, what there is of them, or a default."""
    both = F.concat_ws(between, F.when(~T.blank(code), code), F.when(~T.blank(title), title))
    return F.when(both == "", NO_COURSE).otherwise(both)


def course_documents(courses: DataFrame) -> DataFrame:
    """Cleaned courses as documents with nested metadata."""
    content = T.strip(T.text("content"))
    return courses.select(
        course_title(F.col("code"), F.col("title"), " - ").alias("title"), content.alias("content"), T.script_runs(content).alias("word_count"),
        T.text("url").alias("url"), F.struct("code", "level", "school", "credits", "category").alias("metadata"),
    )


def course_documents_flat(courses: DataFrame) -> DataFrame:
    """The second form: title and content alone."""
    return courses.select(course_title(T.strip(T.text("code")), T.strip(T.text("title")), " ").alias("title"), course_content_flat().alias("content"))


def page_documents(pages: DataFrame, title: Column, content: Column) -> DataFrame:
    return pages.select(
        title.alias("title"), content.alias("content"), T.words(content).alias("word_count"), "url", "depth", "crawl_time",
        F.struct(F.col("title").alias("source_title")).alias("metadata"),
    )


def person_documents(people: DataFrame, title: Column, content: Column) -> DataFrame:
    return people.select(title.alias("title"), content.alias("content"), T.words(content).alias("word_count"), "url")


def index_text(title: Column, content: Column) -> Column:
    """What is indexed: the title under its label before the content, where there is one."""
    return F.when(~T.blank(title), F.concat(F.lit("标题: "), title, F.lit("\n\n"), content)).otherwise(content)


def compact_json(record: Column) -> Column:
    """A struct as JSON without its null fields."""
    return F.to_json(record, {"ignoreNullFields": "true"})


def lineage(df: DataFrame, path: Column) -> DataFrame:
    """Columns from a file's path: faculty (its folder) and scheme (its name without ending)."""
    return df.withColumn("faculty", F.regexp_extract(path, r"([^/]+)/[^/]+\z", 1)).withColumn("scheme", F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?\z", 1))


def merged_sections(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One text per person from pages (ord, name, text): the home page first, others under their names. Pages of one
    person's site are bounded by the site; each group is one person's."""
    body = F.when(T.blank(F.col("name")), F.col("text")).otherwise(F.concat(F.lit("=== "), F.col("name"), F.lit(" ===\n"), F.col("text")))
    items = F.array_sort(F.collect_list(F.struct("ord", body.alias("body"))))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x.body), "\n\n").alias("content"))


def with_site(content: Column, site: Column) -> Column:
    """A profile with its personal site's text below."""
    return F.when(T.blank(site), content).otherwise(F.concat(content, F.lit("\n\n=== 个人网站内容 ===\n"), site))
