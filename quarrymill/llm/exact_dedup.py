"""Exact deduplication: a 128-bit content hash groups, bytes are compared inside groups, the smallest id stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import WORD_SPACE


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WORD_SPACE, " ")


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: content_hash (128 bits), text_sha256, keep_id, group_size.

    The aggregate's keys are the hash and the normalised text, so rows of one hash meet and their bytes are
    compared there: texts that differ under the same hash are different groups. Each map task reduces its copies
    first, so that a group of any size sends one row from each task.
    """
    text = normalised(F.col(text_col))
    return (
        docs.select(F.col(id_col).alias("id"), text.alias("norm"))
        .groupBy(F.unhex(F.md5("norm")).alias("content_hash"), "norm")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("content_hash", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A verdict for every row: (id, keep_id, group_size, kept, text_sha256).

    A null text equals an empty one. A null id is never smaller than another; in a group of null ids alone,
    keep_id is null and all rows are kept. Rows that repeat an id and its text get the same verdict each. Other
    columns of ``docs``, whatever their names, are not read. An empty table gives an empty result. Texts of any length
    are compared whole.

    Only hashes travel to the groups, never texts; a hot group is split by the adaptive skew join, as the other side
    has one row of it.
    """
    groups = content_groups(docs, id_col, text_col)
    norm = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("row_id"), norm.alias("norm")).select(
        "row_id", F.unhex(F.md5("norm")).alias("content_hash"), F.sha2("norm", 256).alias("text_sha256")
    )
    return rows.join(groups, ["content_hash", "text_sha256"]).select(
        F.col("row_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("row_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each distinct text, with all of its columns: the one with the smallest id, of several the one with the
    smaller text as written, then any.

    Equal texts are equal when normalised, as above, and a null text equals an empty one. A row with a null id stays
    only if its text has no other id, and then one of them. A repeated id with another text is another document.
    An empty table gives an empty result. Whole rows are reduced in each map task before they move once; nothing is
    joined, so a group of any size sends one row from each task.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]  # no name of the table's can clash
    row = F.struct(*(docs[c].alias(n) for c, n in zip(docs.columns, names)))
    norm = normalised(docs[text_col])
    id_, text = (F.col(f"row.{names[docs.columns.index(c)]}") for c in (id_col, text_col))
    first = (
        docs.select(F.unhex(F.md5(norm)).alias("content_hash"), norm.alias("norm"), row.alias("row"))
        .groupBy("content_hash", "norm")
        .agg(F.min_by("row", F.struct(id_.isNull().alias("last"), id_.alias("id"), text.alias("text"))).alias("row"))
    )
    return first.select(*(F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, names)))


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
