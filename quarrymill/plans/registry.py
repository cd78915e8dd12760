"""Every query of the engine by name, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.operators import quality, records
from quarrymill.plans import corpus as C
from quarrymill.plans import oracles, record_queries, scheme_queries

_docs = C.of_documents
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_documents": C.clean_documents,
    "clean_report_by_source": C.clean_report_by_source,
    "dedup_mark_before": C.dedup_mark_before,
    "dedup_mark_after": C.dedup_mark_after,
    "quality_page": _docs(reason=quality.page_reason),
    "quality_person": _docs(reason=quality.person_reason),
    "clean_lines_page": _docs(cleaned=quality.page_cleaned),
    "clean_lines_person": _docs(cleaned=quality.person_cleaned),
    "mojibake_repair": _docs(repaired=T.mojibake_repaired),
    "control_strip": _docs(stripped=T.without_controls),
    "word_counts": _docs(words=T.words, script_runs=T.script_runs),
    "info_density": _docs(density=T.density),
    "density_candidates": C.density_candidates,
    "smart_sample": C.smart_sample,
    "seeded_sample": C.seeded_sample,
    "truncate_marker": _docs(cut=lambda c: T.truncated(c, 2800)),
    "head_tail_split": _docs(head=lambda c: T.head(c, 2000), tail=lambda c: T.tail(c, 2000)),
    "mostly_english": _docs(english=T.mostly_english),
    "person_prefilter": _docs(kept=lambda c: quality.person_page(c, F.when(F.col("doc_id") % 2 == 0, "name"))),
    "minimal_page": _docs(minimal=lambda c: quality.minimal_page(c, T.words(c))),
    "compact_squeeze": _docs(compact=lambda c: F.length(T.compact(c)).cast("long"), squeezed=T.squeeze),
    "index_text": _docs(indexed=lambda c: records.index_text(F.col("source"), c)),
    "token_estimate": _docs(embedding_tokens=lambda c: T.tokens_estimated(c, 4), chat_tokens=lambda c: T.tokens_estimated(c, 2)),
    "email_extract": _docs(emails=T.emails),
    "chunk_paragraphs": C.chunk_paragraphs,
    "interleave_sources": C.interleave_sources,
    "resume_offsets": C.resume_offsets,
    "round_robin_shards": C.round_robin_shards,
    "union_of_sources": C.union_of_sources,
    "anti_join_labels": C.anti_join_labels,
    "html_title": C.html_title,
    "html_main": C.html_main,
    "html_links": C.html_links,
    "html_paragraphs": C.html_paragraphs,
    "html_person": C.html_person,
    "frontier_anti_join": C.frontier_anti_join,
    "url_functions": C.url_functions,
    "url_valid": C.url_valid,
    "site_tree": C.site_tree,
    "course_record_build": C.course_record_build,
    "course_record_flat": C.course_record_flat,
    "course_dedup": C.course_dedup,
    "upsert_merge": C.upsert_merge,
    "table_sentences": C.table_sentences,
    "chat_messages": C.chat_messages,
    "context_guard": C.context_guard,
    "qa_prompt": C.qa_prompt,
    "qa_response_validate": C.qa_response_validate,
    "naive_topk": C.naive_topk,
    "batch_topk_per_query": C.batch_topk_per_query,
    **{f"retrieve_{mode}": C.graph_mode(mode) for mode in ("naive", "local", "global", "hybrid", "mix", "bypass")},
    "event_windows": C.event_windows,
    **scheme_queries.QUERIES,
    **record_queries.QUERIES,
}
ORACLES: dict[str, str] = oracles.ORACLES | scheme_queries.ORACLES | record_queries.ORACLES
