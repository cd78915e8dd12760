"""Records, gates, titles, chunks, answers, contexts, samples and files as queries; the SQL is written by itself."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quarrymill.functions import text as T
from quarrymill.functions import urls as U
from quarrymill.operators import chunking, prompts, quality, ranking, records, retrieval
from quarrymill.plans.corpus import courses, docs, graph, query_vector, table
from quarrymill.plans.oracles import CONTENT, COURSES, GRAPH, NS, PAGE_PATTERNS, SCORE, SCRIPT_RUN, TITLE, cleaned, count, person_reason, strip
from quarrymill.session import shared_dir
from quarrymill.sources import files, sinks


def _kinds(number: Column, *values: Column | str | None) -> Column:
    """One of the values by the remainder of a number."""
    out = F.lit(None).cast("string")
    for k, v in enumerate(values):
        if v is not None:
            out = F.when(number % len(values) == k, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def _part(spark, sf) -> DataFrame:
    return table(spark, sf, "part")


def course_documents(spark, sf):
    full = courses(spark, sf).withColumn("content", records.course_content())
    keyed = records.course_documents(full.withColumn("url", F.col("part").cast("string")))
    return keyed.select(F.col("url").cast("long").alias("part"), "title", "word_count", F.col("metadata.code").alias("code"), F.col("metadata.category").alias("category"))


def page_documents(spark, sf):
    d = docs(spark, sf).select(F.col("doc_id").cast("string").alias("url"), "text", F.col("source").alias("title"), F.lit(1).alias("depth"), F.lit("now").alias("crawl_time"))
    return records.page_documents(d, F.upper("title"), F.col("text")).select(F.col("url").cast("long").alias("doc_id"), "title", "word_count", F.col("metadata.source_title").alias("source_title"))


def described_content(spark, sf):
    d = F.col("doc_id")
    description = _kinds(d, None, "  ", F.concat(F.lit(" about "), "source", F.lit("\n")))
    return docs(spark, sf).select("doc_id", F.md5(quality.with_description(F.col("text"), description)).alias("digest"))


def compact_record(spark, sf):
    return courses(spark, sf).select("part", records.compact_json(F.struct("code", "title", "grading", "credits")).alias("record"))


def file_lineage(spark, sf):
    path = F.concat(F.lit("file:/data/"), "p_brand", F.lit("/"), "p_name", F.lit(".v2.json"))
    return records.lineage(_part(spark, sf).select("p_partkey", path.alias("path")), F.col("path")).select("p_partkey", "faculty", "scheme")


def merged_sections(spark, sf):
    k = F.col("p_partkey")
    rows = _part(spark, sf).select((k / 3).cast("long").alias("person"), (k % 3).alias("ord"), F.when(k % 3 > 0, F.col("p_brand")).alias("name"), F.col("p_name").alias("text"))
    return records.merged_sections(rows, ["person"])


def profile_with_site(spark, sf):
    return _part(spark, sf).select("p_partkey", records.with_site(F.col("p_name"), _kinds(F.col("p_partkey"), None, "", F.col("p_type"))).alias("content"))


def person_links(spark, sf):
    k = F.col("p_partkey")
    base = "https://x.example.org"
    url = _kinds(k, f"{base}/a/b/wang", f"{base}/a/b?page=2", f"{base}/zh/teacher/7", f"{base}/news/1/x", "https://www.weibo.com/a/teacher", f"{base}/teacher/list", f"{base}/a/cv.pdf", f"{base}/staff/li", f"{base}/a/b/c", f"{base}/zh-hans/faculty/x")
    text = _kinds(k, "王小明", "Mary", F.col("p_name"), "Ada Byron", "Ada Byron", "Grace", "Grace", "more", F.col("p_name"), "王小明")
    return _part(spark, sf).select("p_partkey", U.person_link(url, text).alias("person"))


def page_titles(spark, sf):
    raw = _kinds(F.col("p_partkey"), F.concat(F.lit(' "'), "p_name", F.lit("' \n")), "SKIP this", " skip ", F.repeat("p_name", 20), "x")
    return _part(spark, sf).select("p_partkey", T.title(raw, 100).alias("page_title"), T.title(raw, 80, 2).alias("person_title"))


def ready_for_model(spark, sf):
    title = _kinds(F.col("doc_id"), F.col("source"), "", None)
    return docs(spark, sf).select("doc_id", quality.ready_for_model(F.concat(F.lit(" "), T.head(F.col("text"), 21), F.lit("\n")), title).alias("ready"))


def kept_content(spark, sf):
    text, d = F.col("text"), F.col("doc_id")
    improved = F.when(d % 3 == 0, T.head(text, 10)).when(d % 3 == 1, F.concat(text, F.lit(" more"))).otherwise(F.lit(" "))
    return docs(spark, sf).select("doc_id", F.md5(quality.kept_content(text, improved)).alias("digest"))


def person_records(spark, sf):
    d = F.col("doc_id")
    name, title = _kinds(d, "", "n", None), _kinds(d, "最新图片 1", "最新图片 1", "x")
    return docs(spark, sf).select("doc_id", quality.person_record(name, title, F.col("text"), T.head(F.col("text"), 100)).alias("kept"))


def overlapping_chunks(spark, sf):
    rows = docs(spark, sf).select("doc_id", F.posexplode(chunking.overlapping(F.col("text"))).alias("nth", "chunk"))
    return rows.select("doc_id", "nth", F.md5("chunk").alias("digest"))


def token_chunks(spark, sf):
    rows = docs(spark, sf).select("doc_id", F.posexplode(chunking.token_chunks(F.col("text"), 300)).alias("nth", "chunk"))
    return rows.select("doc_id", "nth", F.md5("chunk").alias("digest"))


def early_stop(spark, sf):
    k = F.col("p_partkey")
    rows = _part(spark, sf).select(F.floor(k / 25).alias("site"), (k % 25).alias("page_no"), F.when((k % 7 < 3) & (k % 50 > 10), 0).otherwise(k % 5).alias("n_links"))
    return ranking.pages_before_gap(rows)


def course_answers(spark, sf):
    raw = _kinds(F.col("p_partkey"), '{"qas": []}', F.concat(F.lit('{"qas": [{"question": "'), "p_name", F.lit('?", "answer": " yes "}]}')), "no", '{"skip": true}')
    got = _part(spark, sf).select("p_partkey", prompts.qa_answers(raw, "course", False).alias("r"))
    first = F.get("r.qas", F.lit(0))
    return got.select("p_partkey", "r.status", "r.reason", first.question.alias("question"), first.answer.alias("answer"), first.answer_type.alias("answer_type"))


def question_rows(spark, sf):
    raw = _kinds(F.col("p_partkey"), F.concat(F.lit('{"qas": [{"question": "'), "p_name", F.lit('", "answer": "a"}, {"question": "second", "answer": "b", "answer_type": "contact"}]}')), '{"skip": true}', "no")
    got = _part(spark, sf).select("p_partkey", prompts.qa_answers(raw).alias("r"))
    return prompts.qa_records(got, "r", F.col("p_partkey")).select(F.col("source").alias("p_partkey"), "question", "answer", "answer_type")


def scheme_answers(spark, sf):
    raw = _kinds(F.col("p_partkey"), F.concat(F.lit('```json\n{"title": " '), "p_name", F.lit(' ", "content": "c"}\n```')), '{"title": "x"}', "no", '{"title": "t", "content": " d "}')
    return _part(spark, sf).select("p_partkey", prompts.scheme_answer(raw).alias("r")).select("p_partkey", "r.title", "r.content")


def scheme_prompts(spark, sf):
    made = prompts.scheme_prompt(F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("units")), "Read:\n{json_data}\nAnswer.")
    return _part(spark, sf).select("p_partkey", made.alias("prompt"))


def translated(spark, sf):
    answer = _kinds(F.col("doc_id"), "uebersetzt", "", None)
    text = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.concat(F.lit("中文字"), T.head(F.col("text"), 2)))
    return docs(spark, sf).select("doc_id", F.md5(prompts.translated(text, answer)).alias("digest"))


def context_lines(spark, sf):
    best = retrieval.top_k(table(spark, sf, "embeddings"), query_vector(spark, sf), 5)
    found = best.join(docs(spark, sf).select(F.col("doc_id").alias("vec_id"), F.col("source").alias("title"), F.col("doc_id").cast("string").alias("url"), F.col("text").alias("content")), "vec_id")
    return retrieval.context_lines(found.withColumn("worse", -F.col("score")), "worse").select("vec_id", "line")


def context_by_mode(spark, sf):
    """The texts that each mode of the query API answers from."""
    d = docs(spark, sf).select(F.col("doc_id").alias("chunk_id"), F.md5("text").alias("digest"))
    query, tables, out = query_vector(spark, sf), graph(spark, sf), None
    for mode in retrieval.MODES:
        part = retrieval.retrieve(mode, query, *tables, 3).join(d, "chunk_id").select(F.lit(mode).alias("mode"), "chunk_id", "digest")
        out = part if out is None else out.unionByName(part)
    return out


def embedding_service(spark, sf):
    """Two-dimensional vectors of texts by a plain function in the model's place, as the service answers."""
    import numpy as np

    rows = retrieval.embedded(_part(spark, sf).select("p_partkey", "p_name"), "p_name", lambda texts: np.array([[3.0 * len(x), 4.0 * len(x)] for x in texts]))
    got = retrieval.embedding_response(rows, "p_name", "embedding", "p_partkey", "plain")
    return got.select(F.col("index").alias("p_partkey"), "object", "model", "prompt_tokens", *(F.round(F.get("embedding", F.lit(k)).cast("double"), 4).alias(f"v{k}") for k in (0, 1)))


def retried_answers(spark, sf):
    """A model that answers only every other prompt, and raises for long ones: what stays without an answer is null."""

    def model(asked):
        if any(len(a) > 11 for a in asked):
            raise ValueError("too long")
        return [a.upper() if "e" in a else None for a in asked]

    rows = _part(spark, sf).select("p_partkey", F.when(F.length("p_name") <= 11, F.col("p_name")).alias("prompt"))
    return prompts.completed(rows, "prompt", model).select("p_partkey", "answer")


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/query-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def jsonl_round_trip(spark, sf):
    """All documents as JSON lines in a folder for each source, read again with their files' names."""
    path = _folder(spark)
    sinks.by_input(docs(spark, sf).select("doc_id", "text", F.concat(F.lit("raw/"), "source", F.lit(".jsonl")).alias("source_file")), path)
    schema = t.StructType([t.StructField("doc_id", t.LongType()), t.StructField("text", t.StringType())])
    back = files.read_jsonl(spark, f"{path}/*", schema)
    return back.select("doc_id", F.md5("text").alias("digest"), F.regexp_extract("source_file", r"input=([^/]+)\.jsonl/", 1).alias("source"))


def json_files_round_trip(spark, sf):
    """Parts as one array of records, and as lines that are added to in two runs."""
    path, part = _folder(spark), _part(spark, sf).select("p_partkey", "p_name")
    listed = part.where("p_partkey < 100").agg(F.to_json(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name")))).alias("value"))
    listed.coalesce(1).write.text(f"{path}/array")
    for half in (0, 1):
        sinks.write_jsonl(part.where(f"p_partkey % 2 = {half}"), f"{path}/lines", "append")
    schema = t.StructType([t.StructField("p_partkey", t.LongType()), t.StructField("p_name", t.StringType())])
    array = files.read_json_array(spark, f"{path}/array", schema).select(F.lit("array").alias("form"), "p_partkey", "p_name")
    return array.unionByName(files.read_jsonl(spark, f"{path}/lines", schema).select(F.lit("lines").alias("form"), "p_partkey", "p_name"))


def index_tables(spark, sf):
    """An index written anew, then added to twice with the same chunks: keyed rows are there once."""
    path = _folder(spark)
    chunks = docs(spark, sf).select("doc_id", F.col("text").alias("content"))
    none = spark.createDataFrame([], "entity long"), spark.createDataFrame([], "relation long")
    sinks.write_index(chunks.where("doc_id % 2 = 0"), *none, path, recreate=True)
    for _ in range(2):
        sinks.write_index(chunks, *none, path)
    return spark.read.parquet(f"{path}/chunks").groupBy("chunk_key").agg(F.count(F.lit(1)).alias("n"))


def event_stream(spark, sf):
    """Hourly counts by a stream with a watermark, appended as windows close: what a stream of the table has given when
    it ends is the windows that the latest event's watermark has passed."""
    from quarrymill.streaming.incremental import counts_by_window

    path, schema = _folder(spark), table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")  # a pattern takes a file or a folder
    counted = counts_by_window(stream)
    counted.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/windows").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(counted.schema).parquet(f"{path}/windows")
    return got.select(F.col("window_start").cast("string").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        course_documents, page_documents, described_content, compact_record, file_lineage, merged_sections, profile_with_site, person_links, page_titles, ready_for_model, kept_content,
        person_records, overlapping_chunks, token_chunks, early_stop, course_answers, question_rows, scheme_answers, scheme_prompts, translated, context_lines, context_by_mode,
        embedding_service, retried_answers, jsonl_round_trip, json_files_round_trip, index_tables, event_stream,
    )
}

ORACLES = {
    "course_documents": f"WITH {COURSES}, c AS (SELECT *, {CONTENT} AS content FROM courses) SELECT part, {TITLE.format(' - ')} AS title, {count('content', SCRIPT_RUN)} AS word_count, code, category FROM c",
    "page_documents": f"SELECT doc_id, upper(source) AS title, {count('text', NS + '+')} AS word_count, source AS source_title FROM documents",
    "described_content": "SELECT doc_id, md5(CASE WHEN doc_id % 3 = 2 THEN 'about ' || source || chr(10) || chr(10) || text ELSE text END) AS digest FROM documents",
    "compact_record": """
        SELECT p_partkey AS part, '{' || concat_ws(',', CASE WHEN p_partkey % 5 <> 0 THEN '"code":"CSC' || (1000 + p_partkey % 900) || '"' END, CASE WHEN p_partkey % 7 <> 0 THEN '"title":"' || p_name || '"' END,
          '"credits":"' || p_size || '"') || '}' AS record FROM part""",
    "file_lineage": "SELECT p_partkey, p_brand AS faculty, p_name || '.v2' AS scheme FROM part",
    "merged_sections": """
        SELECT p_partkey // 3 AS person, string_agg(CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '=== ' || p_brand || ' ===' || chr(10) || p_name END, chr(10) || chr(10) ORDER BY p_partkey % 3) AS content FROM part GROUP BY 1""",
    "profile_with_site": "SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN p_name || chr(10) || chr(10) || '=== 个人网站内容 ===' || chr(10) || p_type ELSE p_name END AS content FROM part",
    # By the kinds of links: a name, a page of a list, a person's path, news, another site, a list, a file, a button, plain words, a local section.
    "person_links": "SELECT p_partkey, [true, false, true, false, false, false, false, false, false, false][p_partkey % 10 + 1] AS person FROM part",
    "page_titles": """
        SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 3 THEN l100 WHEN 4 THEN 'x' END AS page_title, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 3 THEN l80 END AS person_title
        FROM (SELECT *, substr(repeat(p_name, 20), 1, 100) || '...' AS l100, substr(repeat(p_name, 20), 1, 80) || '...' AS l80 FROM part)""",
    "ready_for_model": f"SELECT doc_id, length({strip('substr(text, 1, 21)')}) >= 20 AND doc_id % 3 = 0 AS ready FROM documents",
    "kept_content": f"""
        WITH c AS ({cleaned(PAGE_PATTERNS, 10, True)}), i AS (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN substr(text, 1, 10) WHEN 1 THEN text || ' more' ELSE ' ' END AS improved FROM documents),
        k AS (SELECT doc_id, CASE WHEN length(improved) < length(text) * 0.3 THEN cleaned ELSE improved END AS chosen FROM i JOIN c USING (doc_id))
        SELECT doc_id, CASE WHEN length({strip('chosen')}) >= 20 THEN md5(chosen) END AS digest FROM k""",
    "person_records": f"SELECT doc_id, doc_id % 3 <> 0 AND length(text) >= 50 AND reason IS NULL AND length(substr(text, 1, 100)) >= 80 AS kept FROM documents JOIN ({person_reason()}) USING (doc_id)",
    "overlapping_chunks": """
        SELECT doc_id, k AS nth, md5(substr(text, k * 864 + 1, 1024)) AS digest
        FROM (SELECT doc_id, text, unnest(range(0, greatest(ceil((length(text) - 160) / 864.0)::BIGINT, 1))) AS k FROM documents)""",
    "token_chunks": f"""
        WITH w AS (SELECT doc_id, regexp_extract_all(text, '{NS}+') AS w FROM documents)
        SELECT doc_id, k AS nth, md5(array_to_string(w[k * 300 + 1:k * 300 + 300], ' ')) AS digest FROM (SELECT doc_id, w, unnest(range(0, greatest((len(w) + 299) // 300, 1))) AS k FROM w)""",
    "early_stop": """
        WITH r AS (SELECT p_partkey // 25 AS site, p_partkey % 25 AS page_no, CASE WHEN p_partkey % 7 < 3 AND p_partkey % 50 > 10 THEN 0 ELSE p_partkey % 5 END AS n_links FROM part),
        s AS (SELECT a.site, min(c.page_no) AS last FROM r a JOIN r b ON a.site = b.site AND b.page_no = a.page_no + 1 JOIN r c ON a.site = c.site AND c.page_no = a.page_no + 2
              WHERE a.n_links = 0 AND b.n_links = 0 AND c.n_links = 0 GROUP BY a.site)
        SELECT site, page_no, n_links FROM r LEFT JOIN s USING (site) WHERE page_no <= coalesce(last, page_no)""",
    "course_answers": """
        SELECT p_partkey, ['ok', 'ok', 'error', 'skip'][p_partkey % 4 + 1] AS status, CASE WHEN p_partkey % 4 = 3 THEN '模型判定样本质量不足' END AS reason, CASE WHEN p_partkey % 4 = 1 THEN p_name || '?' END AS question,
          CASE WHEN p_partkey % 4 = 1 THEN 'yes' END AS answer, CASE WHEN p_partkey % 4 = 1 THEN 'course' END AS answer_type FROM part""",
    "question_rows": """
        SELECT p_partkey, p_name AS question, 'a' AS answer, 'other' AS answer_type FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 'second', 'b', 'contact' FROM part WHERE p_partkey % 3 = 0""",
    "scheme_answers": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 3 THEN 't' END AS title, CASE p_partkey % 4 WHEN 0 THEN 'c' WHEN 3 THEN 'd' END AS content FROM part",
    "scheme_prompts": """
        SELECT p_partkey, concat_ws(chr(10), 'Read:', '{', '  "name" : "' || p_name || '",', '  "units" : ' || p_size, '}', 'Answer.') AS prompt FROM part""",
    "translated": """
        SELECT doc_id, md5(CASE WHEN english AND doc_id % 3 = 0 THEN 'uebersetzt' ELSE t END) AS digest FROM (
          SELECT doc_id, t, len(regexp_extract_all(t, '[a-zA-Z]')) > 0 AND len(regexp_extract_all(t, '[a-zA-Z]')) / (len(regexp_extract_all(t, '[a-zA-Z]')) + len(regexp_extract_all(t, '[\\x{4e00}-\\x{9fff}]'))) > 0.7 AS english
          FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text ELSE '中文字' || substr(text, 1, 2) END AS t FROM documents))""",
    "context_lines": f"""
        WITH b AS (SELECT vec_id, {SCORE} AS score FROM embeddings ORDER BY score DESC, vec_id LIMIT 5)
        SELECT vec_id, '[' || row_number() OVER (ORDER BY score DESC) || '] ' || source || ' | ' || doc_id || chr(10) || substr(text, 1, 150) AS line FROM b JOIN documents ON doc_id = vec_id""",
    "context_by_mode": f"""
        WITH {GRAPH}, m AS (SELECT 'naive' AS mode, chunk_id FROM naive UNION SELECT 'local', chunk_id FROM loc UNION SELECT 'global', chunk_id FROM glo UNION SELECT 'hybrid', chunk_id FROM loc UNION SELECT 'hybrid', chunk_id FROM glo
          UNION SELECT 'mix', chunk_id FROM loc UNION SELECT 'mix', chunk_id FROM glo UNION SELECT 'mix', chunk_id FROM naive)
        SELECT mode, chunk_id, md5(text) AS digest FROM m JOIN documents ON doc_id = chunk_id""",
    "embedding_service": "SELECT p_partkey, 'embedding' AS object, 'plain' AS model, length(p_name) // 4 AS prompt_tokens, 0.6::DOUBLE AS v0, 0.8::DOUBLE AS v1 FROM part",
    "retried_answers": "SELECT p_partkey, CASE WHEN length(p_name) <= 11 AND contains(p_name, 'e') THEN upper(p_name) END AS answer FROM part",
    "jsonl_round_trip": "SELECT doc_id, md5(text) AS digest, source FROM documents",
    "json_files_round_trip": "SELECT 'array' AS form, p_partkey, p_name FROM part WHERE p_partkey < 100 UNION ALL SELECT 'lines', p_partkey, p_name FROM part",
    "event_stream": """
        SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
        WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1, 2""",
    "index_tables": "SELECT DISTINCT sha256(text) AS chunk_key, 1 AS n FROM documents",
}
