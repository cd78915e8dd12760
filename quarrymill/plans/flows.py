"""The flows from raw pages to an index and to questions. Models are functions from lists of prompts to answers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.config import Settings
from quarrymill.functions import text as T
from quarrymill.operators import chunking, prompts, quality, ranking, records, retrieval, schemes
from quarrymill.sources import files, sinks

Model = Callable[[list[str]], Iterable[str | None]]


def clean_raw(spark: SparkSession, source: str, target: str, rules: quality.CleanRules = quality.CleanRules()) -> DataFrame:
    """Raw JSON lines to cleaned ones, a folder for each input file; returns counts and kept shares by file."""
    raw = files.read_jsonl(spark, source, files.SCHEMAS["raw_pages"])
    sinks.by_input(quality.clean_pages(raw, rules).drop("line_no"), target)
    kept = quality.clean_pages(raw, rules).groupBy("source_file").agg(F.count(F.lit(1)).alias("kept"))
    total = raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("total"))
    return total.join(kept, "source_file", "left").select("source_file", "total", F.coalesce("kept", F.lit(0)).alias("kept"), F.round(100.0 * F.coalesce("kept", F.lit(0)) / F.col("total"), 2).alias("kept_percent"))


def page_documents(cleaned: DataFrame, improve: Model, name: Model, settings: Settings = Settings()) -> DataFrame:
    """Cleaned pages to documents: cheap rules before the models, the model's text or the plain one where it lost too
    much, quality of what came out, and a title that the model gives."""
    ready = cleaned.where(quality.ready_for_model(F.col("content"), F.col("title"))).withColumn("prompt", T.head(F.col("content"), settings.page_chars))
    answered = prompts.completed(ready, "prompt", improve, settings.tries)
    better = prompts.improved(F.col("content"), F.col("answer"), settings.page_chars)
    plain = F.when(T.blank(F.col("answer")), quality.page_cleaned(F.col("content"))).otherwise(better)
    kept = answered.withColumn("improved", quality.kept_content(F.col("content"), plain)).where("improved IS NOT NULL")
    good = kept.where(quality.page_reason(F.col("improved")).isNull()).withColumn("prompt", F.concat_ws("\n", "title", T.truncated(F.col("improved"), 3000))).drop("answer")
    titled = prompts.completed(good, "prompt", name, 1).withColumn("new_title", T.title(F.col("answer"), 100)).where("new_title IS NOT NULL")
    return records.page_documents(titled, F.col("new_title"), F.col("improved"))


def person_documents(cleaned: DataFrame, improve: Model, name: Model, settings: Settings = Settings()) -> DataFrame:
    """People's pages to documents: tried again until long enough, and until a title is valid."""
    who = F.col("teacher_info.name")
    ready = cleaned.where(quality.person_page(F.col("content"), who)).withColumn("prompt", T.head(quality.person_cleaned(F.col("content")), settings.person_chars))
    answered = prompts.completed(ready, "prompt", improve, settings.tries, lambda a: len(a.strip()) >= 80).where("answer IS NOT NULL").withColumnRenamed("answer", "improved")
    good = answered.where(quality.person_record(who, F.col("title"), F.col("content"), F.col("improved"))).withColumn("prompt", F.concat_ws("\n", "title", T.truncated(F.col("improved"), 3000)))
    titled = prompts.completed(good, "prompt", name, settings.tries, lambda a: len(a.strip()) >= 2 and not a.strip().upper().startswith("SKIP"))
    titled = titled.withColumn("new_title", T.title(F.col("answer"), 80, 2)).where("new_title IS NOT NULL")
    return records.person_documents(titled, F.col("new_title"), F.col("improved"))


def course_documents(courses: DataFrame, translate: Model, settings: Settings = Settings(), rules: quality.CleanRules = quality.CleanRules()) -> DataFrame:
    """Courses to documents: descriptions that are mostly English are translated, rules come before the first copy of a
    key is taken. ``courses`` has an ordinal ``line_no``."""
    answered = prompts.completed(courses.withColumn("prompt", F.when(T.mostly_english(T.text("description")), F.col("description"))), "prompt", translate, settings.tries)
    done = answered.withColumn("description", prompts.translated(T.text("description"), F.col("answer"))).withColumn("content", records.course_content())
    good = done.where(quality.acceptable(F.col("content"), rules) & quality.course_survives(F.col("code"), F.col("description"), F.col("content")))
    key = F.coalesce(*(F.when(~T.blank(F.col(c)), F.col(c)) for c in ("code", "title", "url")))
    return records.course_documents(quality.first_seen(good.where(key.isNotNull()), key, ["line_no"]))


def scheme_documents(pages: DataFrame, write: Model, settings: Settings = Settings()) -> DataFrame:
    """Pages of schemes (scheme, page_number, text) to one document a scheme, by a model that gets the parsed record."""
    texts = pages.groupBy("scheme").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "text"))), lambda p: p.text), "\n").alias("text"))
    record = schemes.scheme_record(texts)
    asked = record.withColumn("prompt", prompts.scheme_prompt(F.struct(*record.columns)))
    answered = prompts.completed(asked.select("scheme", "prompt"), "prompt", write, settings.tries).withColumn("document", prompts.scheme_answer(F.col("answer")))
    return answered.where("document IS NOT NULL").select("scheme", "document.*")


def question_answers(rows: DataFrame, write: Model, key: str, per_row: int = 1, settings: Settings = Settings()) -> DataFrame:
    """Questions and answers from a sample of the densest rows (title, url, content, word_count and a key)."""
    sample = ranking.smart_sample(rows, T.text("content"), settings.sample_size, settings.top_ratio, key)
    asked = sample.withColumn("prompt", prompts.qa_prompt(F.col("title"), F.col("url"), F.col("content"), per_row, settings.qa_chars))
    answered = prompts.completed(asked, "prompt", write, settings.tries).withColumn("parsed", prompts.qa_answers(F.col("answer")))
    return prompts.qa_records(answered, "parsed", F.struct("title", "url", "word_count"))


def index_chunks(documents: DataFrame, embed: Callable, settings: Settings = Settings(), key: str = "doc_id") -> DataFrame:
    """(key, chunk_id, content, embedding): documents' texts under their titles, packed into chunks and embedded."""
    whole = documents.select(key, records.index_text(F.col("title"), F.col("content")).alias("text"))
    pieces = chunking.text_chunks(whole, settings.chunk_chars, settings.chunk_least)
    ids = pieces.select(key, F.xxhash64(F.col(key), F.col("piece_no")).alias("chunk_id"), "content")
    return retrieval.embedded(ids, "content", embed, batch=settings.embedding_batch)


def answer(question: str, chunks: DataFrame, embed: Callable, complete: Callable[[str], str], settings: Settings = Settings()) -> dict:
    """Embeds a question, takes the best chunks as context, and asks the model."""
    found = retrieval.top_k(chunks, [float(x) for x in embed([question])[0]], settings.top_k, "chunk_id").select("chunk_id", "content", "score")
    context = [r.asDict() for r in found.collect()]
    prompt = "\n\n".join([*(f"[{k}] {c['content']}" for k, c in enumerate(context, 1)), question])
    return {"query": question, "mode": "naive", "answer": complete(prompt), "context": context}


def list_pages(sites: DataFrame) -> DataFrame:
    """(base, max_page) to the pages of a list: the base itself, then ``?keywords=&page=N``."""
    numbered = sites.select("base", F.explode(F.sequence(F.lit(1), F.col("max_page"))).alias("page_no"))
    return numbered.select("base", "page_no", F.when(F.col("page_no") == 1, F.col("base")).otherwise(F.concat("base", F.lit("?keywords=&page="), F.col("page_no").cast("string"))).alias("url"))
