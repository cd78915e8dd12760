"""Sources: JSON lines that tolerate bad ones, JSON arrays and objects by file, page tables, and raw HTML files."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quarrymill.functions import text as T

STRING, INT = t.StringType(), t.IntegerType()


def struct(**fields: t.DataType) -> t.StructType:
    return t.StructType([t.StructField(k, v) for k, v in fields.items()])


PERSON = struct(name=STRING, title=STRING, email=STRING, department=STRING, research_areas=STRING, bio=STRING)
#: The tables of the pipeline by name.
SCHEMAS = {
    "raw_pages": struct(title=STRING, content=STRING, meta_description=STRING, word_count=INT, url=STRING, depth=INT, crawl_time=STRING),
    "raw_people": struct(
        url=STRING, title=STRING, content=STRING, teacher_info=PERSON, word_count=INT, personal_website_url=STRING, crawl_time=STRING,
        personal_website_crawled=t.BooleanType(), personal_website_pages_crawled=INT,
    ),
    "courses": struct(**dict.fromkeys("code title level school credits grading teaching_mode term category url description content".split(), STRING)),
    "index_input": struct(title=STRING, content=STRING, url=STRING),
    "answers": struct(question=STRING, answer=STRING, answer_type=STRING, confidence_note=STRING, source=struct(title=STRING, url=STRING, word_count=INT)),
}


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source_file, line_no, value): every line, blank ones too, numbered from 1 within its file.

    Files may be split between tasks: lines are numbered within their block, and blocks' counts add up along the file,
    so that no file has to be in one task.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"))
    marked = raw.withColumn("_at", F.monotonically_increasing_id())
    sizes = marked.groupBy("source_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("source_file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return marked.join(starts, ["source_file", "_block"]).select("source_file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line_no"), "value")


def parsed_lines(lines: DataFrame, schema: t.StructType) -> DataFrame:
    """Lines as records, with ``_bad`` for those that aren't JSON objects; blank lines go."""
    whole = t.StructType([*schema.fields, t.StructField("_bad", STRING)])
    record = F.from_json(T.strip(F.col("value")), whole, {"columnNameOfCorruptRecord": "_bad"})
    rest = [c for c in lines.columns if c != "value"]
    return lines.where(T.strip(F.col("value")) != "").withColumn("_r", record).select(*rest, "_r.*")


def read_jsonl(spark: SparkSession, path: str | list[str], schema: t.StructType) -> DataFrame:
    """Records of JSON-lines files with source_file and line_no; blank and bad lines are left out."""
    return parsed_lines(numbered_lines(spark, path), schema).where("_bad IS NULL").drop("_bad")


def read_index_input(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records with content; titles and links that are missing get defaults."""
    rows = read_jsonl(spark, path, SCHEMAS["index_input"]).where(~T.blank(F.col("content")))
    return rows.withColumn("title", F.coalesce("title", F.lit("未知标题"))).withColumn("url", F.coalesce("url", F.lit("")))


def read_json_array(spark: SparkSession, path: str, schema: t.StructType) -> DataFrame:
    """A file that is one array of records."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_json_objects(spark: SparkSession, path: str, schema: t.StructType, limit: int | None = None) -> DataFrame:
    """One object per file, with source_file; ``limit`` takes the first files by name."""
    rows = spark.read.schema(schema).json(path, multiLine=True).withColumn("source_file", F.col("_metadata.file_path"))
    return rows if limit is None else rows.orderBy("source_file").limit(limit)


def decoded(raw: bytes | None, detect: Callable[[bytes], str | None] | None = None) -> str:
    """UTF-8. Where, in a text of over 100 characters, too much of what isn't ASCII among the first 1000 isn't an
    ideograph: the encoding that ``detect`` names, or GBK without a detector."""
    text = (raw or b"").decode("utf-8", errors="replace")
    odd = [c for c in text[:1000] if ord(c) > 127]
    if len(text) > 100 and odd and sum(not "一" <= c <= "鿿" for c in odd) > 0.3 * len(odd):
        encoding = detect(raw) if detect else "gbk"
        if encoding and encoding.lower() != "utf-8":
            return raw.decode(encoding, errors="replace")
    return text


def read_html_files(spark: SparkSession, path: str, detect: Callable[[bytes], str | None] | None = None) -> DataFrame:
    """(url, html): the files' paths and decoded contents."""

    @F.pandas_udf("string")
    def decode(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: decoded(b, detect))

    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), decode("content").alias("html"))


def read_pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """(pdf_path, page_number, text, tables) by the optional library pdfplumber; without it an ImportError says so."""
    import pdfplumber  # noqa: F401  an optional dependency

    def pages(found):
        import io

        import pdfplumber

        for batch in found:
            for name, raw in zip(batch["path"], batch["content"]):
                with pdfplumber.open(io.BytesIO(raw)) as pdf:
                    rows = [(name, k, p.extract_text(layout=True) or "", p.extract_tables({"vertical_strategy": "lines", "horizontal_strategy": "lines"})) for k, p in enumerate(pdf.pages, 1)]
                yield pd.DataFrame(rows, columns=["pdf_path", "page_number", "text", "tables"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(path)
    return files.select("path", "content").mapInPandas(pages, "pdf_path string, page_number int, text string, tables array<array<array<string>>>")
