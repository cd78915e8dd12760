"""The engine's operators as queries over the standard tables. Thresholds are given where the tables, which are in Latin
script, would pass none of the defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.functions import urls as U
from quarrymill.operators import chunking, pages, prompts, quality, ranking, records, retrieval, schemes

#: ASCII and digit shares that part the documents.
RULES = quality.CleanRules(ascii_share=0.97, digit_share=0.05)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")



def clean_documents(spark, sf):
    first = quality.first_seen(docs(spark, sf), F.md5("text"), ["doc_id"])
    return first.where(quality.acceptable(F.col("text"), RULES)).select("doc_id", "source")


def clean_report_by_source(spark, sf):
    """One scan; texts stay where they are, and what moves is a row for each text, source and task."""
    d = docs(spark, sf).select("doc_id", "source", F.md5("text").alias("key"), quality.acceptable(F.col("text"), RULES).alias("good"))
    of_source = d.groupBy("key", "source").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "good")).alias("first"))
    of_key = of_source.groupBy("key").agg(F.collect_list(F.struct("source", "n", "first")).alias("sources"), F.min("first.doc_id").alias("doc_id"))
    each = of_key.select("doc_id", F.explode("sources").alias("s")).select(
        "s.source", "s.n", F.coalesce((F.col("s.first.doc_id") == F.col("doc_id")) & F.col("s.first.good"), F.lit(False)).cast("long").alias("kept")
    )
    return each.groupBy("source").agg(F.sum("n").alias("total"), F.sum("kept").alias("kept")).withColumn("kept_percent", F.round(100.0 * F.col("kept") / F.col("total"), 2))


def dedup_mark_before(spark, sf):
    first = quality.first_seen(docs(spark, sf), F.md5("text"), ["doc_id"], ["source"])
    return first.where(F.length(T.compact(F.col("text"))) >= 400).select("doc_id", "source")


def dedup_mark_after(spark, sf):
    good = docs(spark, sf).where(F.length(T.compact(F.col("text"))) >= 400)
    return quality.first_seen(good, F.md5("text"), ["doc_id"], ["source"]).select("doc_id", "source")


def of_documents(**columns):
    def query(spark, sf):
        return docs(spark, sf).select("doc_id", *(make(F.col("text")).alias(name) for name, make in columns.items()))

    return query


def density_candidates(spark, sf):
    return ranking.density_pool(docs(spark, sf), F.col("text"), 50, 2.0, ["doc_id"]).select("doc_id", "density")


def smart_sample(spark, sf):
    return ranking.smart_sample(docs(spark, sf), F.col("text"), 50, 2.0, "doc_id").select("doc_id", "density")


def seeded_sample(spark, sf):
    return ranking.sample(docs(spark, sf), 100, "doc_id").select("doc_id")


def chunk_paragraphs(spark, sf):
    split = docs(spark, sf).select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return chunking.text_chunks(split).select("doc_id", F.col("piece_no").cast("long").alias("piece_no"), F.length("content").cast("long").alias("n"), F.md5("content").alias("digest"))


def interleave_sources(spark, sf):
    rows = docs(spark, sf).select("doc_id", "source")
    return ranking.interleaved(rows, 2, "source", "doc_id").select("doc_id", "source", "file_ordinal", "place", "round")


def resume_offsets(spark, sf):
    rows = docs(spark, sf).select("doc_id", "source")
    offsets = rows.where("doc_id % 3 = 0").groupBy("source").agg((F.max("doc_id") / 2).cast("long").alias("line_offset")).where("source <> 'src3'")
    return ranking.after_offsets(rows, offsets, "source", "doc_id")


def round_robin_shards(spark, sf):
    return ranking.sharded(docs(spark, sf), F.col("doc_id"), 7).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))


def union_of_sources(spark, sf):
    """The table holds the files of all sources, so their union is one scan of it."""
    return docs(spark, sf).select("doc_id", "source")


def anti_join_labels(spark, sf):
    return ranking.without_known(docs(spark, sf).select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


def page_table(spark, sf):
    return table(spark, sf, "pages")


def html_title(spark, sf):
    return pages.extracted(page_table(spark, sf), "title").select("page_id", "title")


def html_main(spark, sf):
    return pages.extracted(page_table(spark, sf), "content", "word_count", "meta_description").select("page_id", "content", "word_count", "meta_description")


def html_links(spark, sf):
    return pages.link_rows(pages.extracted(page_table(spark, sf), "links")).select("page_id", F.col("pos").cast("long").alias("pos"), "text", "url")


def html_paragraphs(spark, sf):
    return pages.extracted(page_table(spark, sf), "paragraphs").select("page_id", F.posexplode("paragraphs").alias("pos", "paragraph"))


def html_person(spark, sf):
    return pages.extracted(page_table(spark, sf), "max_page", "person").select("page_id", "max_page", "person.name", "person.email", "person.site")


def frontier_anti_join(spark, sf):
    found = pages.link_rows(pages.extracted(page_table(spark, sf), "links")).select(U.normalised(F.col("url")).alias("url")).distinct()
    return ranking.without_known(found, page_table(spark, sf).select(U.normalised(F.col("url")).alias("url")), "url")


def url_functions(spark, sf):
    url = F.col("url")
    return page_table(spark, sf).select(
        "page_id", U.normalised(url).alias("normalised"), U.bare(url).alias("bare"), U.slug_of_site(url).alias("slug"), U.safe_filename(url).alias("filename"),
        U.relative_depth(url, F.lit("https://a.example/en")).alias("depth"), U.crawlable(F.replace(url, F.lit("/en/"), F.lit("/zh/")), ["therhe.example.org", "ththan.example.com"]).alias("crawlable"),
    )


def url_valid(spark, sf):
    rows = page_table(spark, sf).select("page_id", "url", U.host(F.col("url")).alias("host"))
    hosts = rows.select(F.col("host").alias("listed")).distinct()
    listed = F.when(F.col("host").isNotNull(), F.col("listed").isNotNull())
    return rows.join(hosts, F.col("host") == F.col("listed"), "left").select("page_id", U.crawlable(F.col("url"), listed).alias("valid"))


def site_tree(spark, sf):
    return pages.site_tree(page_table(spark, sf).withColumn("title", F.lit(""))).groupBy("path_segments").agg(F.count(F.lit(1)).alias("n"))


def courses(spark, sf):
    """Parts as courses; some fields are missing, and codes repeat."""
    p = F.col("p_partkey")
    return table(spark, sf, "part").select(
        p.alias("part"), F.when(p % 5 != 0, F.concat(F.lit("CSC"), (1000 + p % 900).cast("string"))).alias("code"), F.when(p % 7 != 0, F.col("p_name")).alias("title"),
        F.when(p % 3 == 0, "").otherwise(F.col("p_brand")).alias("level"), F.col("p_type").alias("school"), F.col("p_size").cast("string").alias("credits"),
        F.lit(None).cast("string").alias("grading"), F.lit("").alias("teaching_mode"), F.lit("2").alias("term"), F.when(p % 2 == 0, "major").alias("category"),
        F.lit("http://x").alias("url"), F.when(p % 4 == 0, F.concat(F.lit("about "), F.col("p_name"))).alias("description"), F.lit(None).cast("string").alias("content"),
    )


def course_record_build(spark, sf):
    full = courses(spark, sf).withColumn("content", records.course_content())
    return full.select("part", records.course_title(F.col("code"), F.col("title"), " - ").alias("title"), "content", T.script_runs(F.col("content")).alias("word_count"))


def course_record_flat(spark, sf):
    return courses(spark, sf).select("part", records.course_title(F.col("code"), F.col("title"), " ").alias("title"), records.course_content_flat().alias("content"))


def course_dedup(spark, sf):
    full = courses(spark, sf).withColumn("content", records.course_content())
    good = full.where((F.length(T.compact(F.col("content"))) >= 60) & quality.course_survives(F.col("code"), F.col("description"), F.col("content")))
    blank_out = [F.when(~T.blank(F.col(c)), F.col(c)) for c in ("code", "title", "url")]
    return quality.first_seen(good, F.coalesce(*blank_out), ["part"]).select("part", "code", "title")


def upsert_merge(spark, sf):
    """Parts up to size 30 are listed and those from 20 tabled, so that each is on one side at least, and some on both."""
    p = F.col("p_partkey")
    part = table(spark, sf, "part")
    code = F.concat(F.lit("CSC"), (1000 + p % 1000).cast("string"))
    none = F.lit(None).cast("string")
    listed = part.where("p_size <= 30").select(
        F.col("p_brand").alias("scheme"), code.alias("code"), p.alias("list_no"), F.lit("required").alias("course_type"), F.when(p % 4 == 0, F.col("p_name")).alias("name_en"),
        none.alias("name_zh"), F.when(p % 3 == 0, F.col("p_size")).alias("units"), F.lit(1000).alias("level"),
    )
    tabled = part.where("p_size >= 20 OR p_size IS NULL").select(
        F.col("p_brand").alias("scheme"), code.alias("code"), p.alias("row_no"), F.concat(F.lit("T "), F.col("p_name")).alias("name_en"), none.alias("name_zh"),
        (F.col("p_size") + 100).alias("units"), F.lit(1000).alias("level"),
    )
    return schemes.merged_courses(listed, tabled).select("scheme", "code", "course_type", "name_en", F.col("units").cast("long").alias("units"))


def table_sentences(spark, sf):
    nation = table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("page_number")).agg(
        F.array_sort(F.collect_list(F.array(F.lpad(F.col("n_nationkey").cast("string"), 3, "0"), "n_name"))).alias("cells")
    )
    rows = nation.select(F.lit("s").alias("scheme"), F.lit("f").alias("faculty"), "page_number", F.concat(F.array(F.array(F.lit("key"), F.lit(""))), "cells").alias("rows"))
    return chunking.table_sentences(rows).select("page_number", "row_idx", "content")


def chat_messages(spark, sf):
    """A row per user turn: the system text of its conversation, all that was said before as history, the turn, and what
    answers it up to the next one. A conversation without a user turn gives one row."""
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    leads = lambda t: F.coalesce(t.role == "system", F.lit(False))
    text = F.transform(F.filter("turns", leads), lambda t: t["text"])
    parted = turns.select("conv_id", "turns", F.when(F.size(text) > 0, F.array_join(text, "\n\n")).alias("system"), F.filter("turns", lambda t: ~leads(t)).alias("said"))
    asked = F.filter(F.sequence(F.lit(1), F.greatest(F.size("said"), F.lit(1))), lambda k: F.coalesce(F.get("said", k - 1).role == "user", F.lit(False)))
    starts = parted.withColumn("starts", F.when(F.size(asked) > 0, asked).otherwise(F.array(F.lit(1))))
    each = starts.select("*", F.posexplode("starts").alias("n", "start"))
    end = F.coalesce(F.get("starts", F.col("n") + 1), F.size("said") + 1)
    said = F.transform("said", lambda t: F.struct(t.role.alias("role"), t["text"].alias("content")))
    found, history = F.slice(said, F.col("start"), end - F.col("start")), F.slice(said, F.lit(1), F.col("start") - 1)
    turn = F.coalesce(F.get("said", F.col("start") - 1).turn, F.get("turns", F.lit(0)).turn)
    return each.select("conv_id", turn.alias("turn"), F.to_json(prompts.assembled(found, F.col("system"), history)).alias("messages"))


def context_guard(spark, sf):
    both = prompts.guarded(prompts.messages(F.lit("s"), F.repeat(F.col("text"), 8)), 900)
    return docs(spark, sf).select("doc_id", F.length(F.get(both, F.lit(1)).content).cast("long").alias("n"), F.substr(F.get(both, F.lit(1)).content, F.greatest(F.length(F.get(both, F.lit(1)).content) - 20, F.lit(1))).alias("ending"))


def qa_prompt(spark, sf):
    return docs(spark, sf).select("doc_id", prompts.qa_prompt(F.col("source"), F.lit(None).cast("string"), F.col("text"), 2).alias("prompt"))


def qa_response_validate(spark, sf):
    d = F.col("doc_id")
    raw = (
        F.when(d % 6 == 0, '{"skip": true, "reason": "noise"}').when(d % 6 == 1, "not json").when(d % 6 == 2, '```json\n{"qas": [{"question": " q ", "answer": "a"}]}\n```')
        .when(d % 6 == 3, '{"qas": []}').when(d % 6 == 4, '{"qas": [{"question": "", "answer": "x"}, 5, {"question": "q2", "answer": "b", "answer_type": "contact"}]}').otherwise('{"other": 1}')
    )
    got = docs(spark, sf).select("doc_id", prompts.qa_answers(raw).alias("r"))
    return got.select("doc_id", "r.status", "r.reason", F.size("r.qas").cast("long").alias("n"), F.get("r.qas", F.lit(0)).question.alias("question"), F.get("r.qas", F.lit(0)).answer_type.alias("answer_type"))


def query_vector(spark, sf) -> list[float]:
    return [float(x) for x in table(spark, sf, "embeddings").where("vec_id = 0").first().embedding]


def naive_topk(spark, sf):
    found = retrieval.top_k(table(spark, sf, "embeddings"), query_vector(spark, sf), 10)
    return found.select("vec_id", F.round("score", 6).alias("score"))


def batch_topk_per_query(spark, sf):
    vectors = table(spark, sf, "embeddings")
    questions = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q_vector"))
    return retrieval.top_k_each(vectors, questions, 5).select("q_id", "vec_id", "rank", F.round("score", 6).alias("score"))


def graph(spark, sf):
    """Chunks, entities (the first vector of each label) and relations (every vector, between neighbour labels)."""
    vectors = table(spark, sf, "embeddings")
    chunks = vectors.select(F.col("vec_id").alias("chunk_id"), "embedding")
    entities = vectors.groupBy(F.col("label").alias("entity")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    relations = vectors.select(
        F.col("vec_id").alias("relation"), F.col("label").alias("src"), ((F.col("label") + 1) % 10).alias("dst"), "embedding", F.col("vec_id").alias("chunk_id")
    )
    return chunks, entities, relations


def graph_mode(mode: str):
    return lambda spark, sf: retrieval.retrieve(mode, query_vector(spark, sf), *graph(spark, sf), 3)


def event_windows(spark, sf):
    from quarrymill.streaming.incremental import counts_by_window

    got = counts_by_window(table(spark, sf, "events"))
    return got.select(F.col("window_start").cast("string").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))
