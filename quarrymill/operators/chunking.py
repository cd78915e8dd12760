"""Chunks of texts and of table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import text as T


def packed(c: Column, most: int) -> Column:
    """Paragraphs packed in order into pieces of about ``most`` characters.

    A paragraph joins the piece while its length and what has been counted stay within ``most``; a join counts two more
    for the break, but the first paragraph after a full piece counts without. A paragraph over ``most`` is cut into
    slices by itself.
    """
    paragraphs = F.filter(F.transform(F.split(c, "\n\n"), T.strip), lambda p: p != "")
    strings = F.array().cast("array<string>")
    start = F.struct(strings.alias("pieces"), strings.alias("buffer"), F.lit(0).alias("used"))

    def flushed(a: Column) -> Column:
        return F.when(F.size(a.buffer) > 0, F.concat(a.pieces, F.array(F.array_join(a.buffer, "\n\n")))).otherwise(a.pieces)

    def step(a: Column, p: Column) -> Column:
        n = F.length(p)
        slices = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / most).cast("int")), lambda k: F.substr(p, k * most + 1, F.lit(most)))
        return (
            F.when(a.used + n <= most, F.struct(a.pieces.alias("pieces"), F.concat(a.buffer, F.array(p)).alias("buffer"), (a.used + n + 2).alias("used")))
            .when(n > most, F.struct(F.concat(flushed(a), slices).alias("pieces"), strings.alias("buffer"), F.lit(0).alias("used")))
            .otherwise(F.struct(flushed(a).alias("pieces"), F.array(p).alias("buffer"), n.alias("used")))
        )

    return F.aggregate(paragraphs, start, step, flushed)


def text_chunks(pages: DataFrame, most: int = 800, least: int = 30, text: str = "text") -> DataFrame:
    """One row per piece (piece_no, content) with the pages' other columns; pieces under ``least`` characters go."""
    rest = [c for c in pages.columns if c != text]
    return pages.select(*rest, F.posexplode(packed(T.pdf_cleaned(T.text(text)), most)).alias("piece_no", "content")).where(F.length("content") >= least)


def table_sentences(tables: DataFrame) -> DataFrame:
    """One row (row_idx, content) for each data row of a table: (scheme, faculty, page_number, rows).

    The first row is the header if any of its cells isn't blank; row numbers start at 1 then, else at 0. A cell reads
    ``column：value``; columns without a name are numbered; a cell is left out if neither has text.
    """
    stripped = F.transform("rows", lambda r: F.transform(r, lambda x: T.strip(T.text(x))))
    named = F.exists(F.get("cells", F.lit(0)), lambda x: x != "")
    body = F.when(F.col("named"), F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0)))).otherwise(F.col("cells"))
    name = lambda k: F.when(F.col("named"), T.text(F.get(F.get("cells", F.lit(0)), k))).otherwise(F.lit(""))
    pair = lambda v, k: F.when((v == "") & F.col("named") & (name(k) == ""), None).otherwise(
        F.concat(F.when(name(k) == "", F.concat(F.lit("列"), (k + 1).cast("string"))).otherwise(name(k)), F.lit("："), v)
    )
    head = F.concat("scheme", F.lit("（"), "faculty", F.lit("）第"), F.col("page_number").cast("string"), F.lit("页表格："))
    rest = [c for c in tables.columns if c != "rows"]
    return (
        tables.where(F.size("rows") > 0).withColumn("cells", stripped).withColumn("named", F.coalesce(named, F.lit(False)))
        .select(*rest, "cells", "named", F.posexplode(body).alias("_at", "_row"))
        .withColumn("pairs", F.filter(F.transform("_row", pair), lambda x: x.isNotNull()))
        .where(F.size("pairs") > 0)
        .select(*rest, (F.col("_at") + F.col("named").cast("int")).cast("long").alias("row_idx"), F.concat(head, F.array_join("pairs", "；")).alias("content"))
    )


def overlapping(c: Column, size: int = 1024, overlap: int = 160) -> Column:
    """Slices of ``size`` characters, each beginning ``overlap`` before the last one's end (an extra)."""
    step = size - overlap
    last = F.greatest(F.ceil((F.length(c) - overlap) / step) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.substr(c, k * step + 1, F.lit(size)))


def token_chunks(c: Column, size: int = 1000) -> Column:
    """Slices of ``size`` words (an extra)."""
    found = F.regexp_extract_all(c, F.lit(f"{T.NOT_SPACE}+"), F.lit(0))
    last = F.floor(F.greatest(F.size(found) - 1, F.lit(0)) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.array_join(F.slice(found, k * size + 1, F.lit(size)), " "))
