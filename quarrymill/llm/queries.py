"""The queries of this package by name, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrymill.llm import bpe, decontam, exact_dedup, html_text, langid, ngram_join, pii, quotes, substring, toxicity
from quarrymill.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": lambda spark, sf: ngram_join.near_copies(table(spark, sf, "documents")),
    "op2_quote_links": lambda spark, sf: quotes.reply_order(table(spark, sf, "conversations")),
    "op3_language_id": lambda spark, sf: langid.language_report(table(spark, sf, "documents")),
    "op4_exact_dedup": lambda spark, sf: exact_dedup.exact_duplicates(table(spark, sf, "documents")),
    "op5_byte_bpe": lambda spark, sf: bpe.encoding_digests(table(spark, sf, "documents")),
    "op6_toxicity": lambda spark, sf: toxicity.toxicity_report(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op7_pii": lambda spark, sf: pii.personal_data_report(table(spark, sf, "documents")),
    "op8_decontamination": lambda spark, sf: decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op9_substring_dedup": lambda spark, sf: substring.removal_digests(table(spark, sf, "documents")),
    "op10_html_text": lambda spark, sf: html_text.extract_pages(table(spark, sf, "pages")),
}

ORACLES: dict[str, str] = {
    "op1_ngram_join": ngram_join.ORACLE_SQL,
    "op4_exact_dedup": exact_dedup.ORACLE_SQL,
    "op8_decontamination": decontam.ORACLE_SQL,
    "op9_substring_dedup": substring.ORACLE_SQL,
}
