"""The corpus pipeline: language ID, exact dedup, near-copy dedup, benchmark decontamination, tokens.

Each stage works on all that the one before kept and is written before the next reads it. All but the last return the
columns of ``documents``. Rows are judged by their texts (near and exact copies by text and id), so rows without an id and
rows that share one with another text are rows like any other. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrymill.llm import bpe, decontam, exact_dedup, langid, ngram_join
from quarrymill.llm.common import stage, table, unstage
from quarrymill.session import prepare


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts in no language (null, empty or without a letter), and those whose words no learned language fits
    well, go. Without any labelled row all go."""
    prepare(spark)
    return langid.accepted(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of texts that are equal but for white space the smallest doc_id stays; a null counts as the largest."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of documents that links of 0.8 or more of five-word shingles connect, the smallest doc_id
    stays. Documents without words link with nothing and stay, as do rows without an id."""
    return ngram_join.drop_near_copies(docs, n=5, tenths=8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows that hold 0.8 of a test item's five-word shingles go, with or without an id."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: ids, and the digests of ids and of the bytes decoded from them, a row for each row."""
    return bpe.encoded_with_digests(docs)


STAGES = [
    ("language ID", keep_languages),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", tokens),
]

#: A trained model and a tokenizer are beyond SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again before the next, and then deleted."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        before, docs = docs, stage(step(spark, docs, sf_dir), f"pipeline-{k}")
        unstage(before)
    return docs
