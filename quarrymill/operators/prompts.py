"""Prompts out of records, and records out of a model's answers. The model itself is any function that is passed in."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import text as T

# Defaults and limits of the calls (fixed values).
ANSWER_TYPES = ("descriptive", "procedural", "comparative", "eligibility", "contact", "other")
POOR = "模型判定样本质量不足"
NOT_SENT = ("hashing_kv", "system_prompt", "history_messages", "extra_body", "extra_headers", "response_format")
CONTEXT, CHARS_PER_TOKEN = 30_000, 2

QA_TEMPLATE = (
    "标题：{title}\n链接：{url}\n正文（{content_length} 字）：\n{content}\n\n"
    '请仅依据正文写出 {qa_count} 组问答，以 JSON 返回 {{"qas": [...]}}；材料不可用时返回 {{"skip": true, "reason": "..."}}。'
)


def filled(template: str, values: dict[str, Column]) -> Column:
    """A template with ``{name}`` places as an expression."""
    import string

    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def qa_prompt(title: Column, url: Column, content: Column, count: int = 1, most: int = 2800, template: str = QA_TEMPLATE) -> Column:
    """The question prompt: missing titles and links get defaults, the content is cut, and its length counts the mark."""
    cut = T.truncated(T.strip(T.text(content)), most)
    return filled(template, {"title": F.coalesce(title, F.lit("未知标题")), "url": F.coalesce(url, F.lit("未知链接")), "content": cut, "content_length": F.length(cut), "qa_count": F.lit(count)})


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(system: Column, user: Column) -> Column:
    return F.array(message("system", system), message("user", user))


def scheme_prompt(record: Column, template: str = "{json_data}") -> Column:
    return filled(template, {"json_data": F.to_json(record, {"pretty": "true"})})


def assembled(found: Column, system: Column, history: Column) -> Column:
    """Messages with the system prompt first, if there is one, and the history after the first system message."""
    none = F.slice(found, 1, 0)
    first = F.when(~T.blank(system), F.concat(F.array(message("system", system)), found)).otherwise(found)
    past = F.coalesce(history, none)
    led = F.get(first, F.lit(0)).role == "system"
    return F.when(F.coalesce(led, F.lit(False)), F.concat(F.slice(first, 1, 1), past, F.slice(first, 2, F.greatest(F.size(first), F.lit(1))))).otherwise(F.concat(past, first))


def guarded(found: Column, most: int = CONTEXT) -> Column:
    """Messages cut to equal shares of the context if all together go beyond it."""
    total = F.aggregate(found, F.lit(0), lambda n, m: n + F.length(T.text(m.content)))
    share = (F.floor(F.lit(most * 2) / F.size(found)) * 2).cast("int")
    cut = lambda m: F.when(F.length(m.content) > share, F.concat(F.substr(m.content, F.lit(1), share), F.lit(T.CHAT_CUT))).otherwise(m.content)
    return F.when(F.floor(total / CHARS_PER_TOKEN) > most, F.transform(found, lambda m: F.struct(m.role.alias("role"), cut(m).alias("content")))).otherwise(found)


def sent_parameters(given: Column) -> Column:
    """A map of call parameters without those that a server doesn't take."""
    return F.map_filter(given, lambda k, v: ~k.isin(*NOT_SENT))


_TOP = "struct<skip:string,reason:string,message:string,qas:string,broken:string>"
_ITEM = "struct<question:string,answer:string,answer_type:string,confidence_note:string>"


def qa_answers(raw: Column, default_type: str = "other", empty_is_error: bool = True) -> Column:
    """struct(status, reason, qas) of a model's answer: ``ok``, ``skip`` with its reason, or ``error``.

    The text without its fence must be a JSON object. Items need a question and an answer; both are stripped.
    """
    top = F.from_json(T.fences_stripped(T.text(raw)), _TOP, {"columnNameOfCorruptRecord": "broken"})
    items = F.from_json(top.qas, "array<string>")
    read = F.transform(items, lambda x: F.from_json(x, _ITEM))
    good = F.filter(read, lambda x: ~T.blank(x.question) & ~T.blank(x.answer))
    made = F.transform(
        good,
        lambda x: F.struct(
            T.strip(x.question).alias("question"), T.strip(x.answer).alias("answer"), F.coalesce(x.answer_type, F.lit(default_type)).alias("answer_type"),
            T.strip(T.text(x.confidence_note)).alias("confidence_note"),
        ),
    )
    skipped = ~T.blank(top.skip) & ~top.skip.isin("false", "0", "0.0", "[]", "{}")
    reason = F.coalesce(F.when(top.reason != "", top.reason), F.when(top.message != "", top.message), F.lit(POOR))
    bad = top.isNull() | top.broken.isNotNull() | items.isNull()
    if empty_is_error:
        bad = bad | (F.size(made) == 0)
    none = F.array().cast("array<struct<question:string,answer:string,answer_type:string,confidence_note:string>>")
    return F.struct(
        F.when(top.broken.isNull() & skipped, "skip").when(F.coalesce(bad, F.lit(True)), "error").otherwise("ok").alias("status"),
        F.when(top.broken.isNull() & skipped, reason).alias("reason"),
        F.when(F.coalesce(skipped | bad, F.lit(True)), none).otherwise(made).alias("qas"),
    )


def qa_records(rows: DataFrame, answers: str, source: Column) -> DataFrame:
    """One row per question of good answers, with its source."""
    return rows.where(F.col(f"{answers}.status") == "ok").select(F.explode(f"{answers}.qas").alias("qa"), source.alias("source")).select("qa.*", "source")


def scheme_answer(raw: Column) -> Column:
    """struct(title, content) of a model's answer; null unless it has both."""
    top = F.from_json(T.fences_stripped(T.text(raw)), "struct<title:string,content:string>")
    return F.when(~T.blank(top.title) & ~T.blank(top.content), F.struct(T.strip(top.title).alias("title"), T.strip(top.content).alias("content")))


def completed(rows: DataFrame, prompt: str, model: Callable[[list[str]], Iterable[str | None]], tries: int = 3, accept: Callable[[str], bool] = bool, out: str = "answer", wait: float = 0.0) -> DataFrame:
    """Adds the model's answers. It gets lists of prompts; prompts without an acceptable answer are tried again, up to
    ``tries`` times, and stay null then. An error of the model counts as no answer. Before the second try it waits
    ``wait`` seconds, and twice as long before each further one."""
    kept = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{out}` string"

    def call(found):
        for batch in found:
            prompts = batch.column(kept.index(prompt)).to_pylist()
            answers: list[str | None] = [None] * len(prompts)
            for turn in range(tries):
                left = [k for k, a in enumerate(answers) if a is None and prompts[k] is not None]
                if not left:
                    break
                if turn and wait:
                    time.sleep(wait * 2 ** (turn - 1))
                try:
                    for k, a in zip(left, model([prompts[k] for k in left])):
                        if a is not None and accept(a):
                            answers[k] = a
                except Exception:  # noqa: BLE001  whatever the model raises, the next try or null follows
                    continue
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string())], names=[*kept, out])

    return rows.mapInArrow(call, schema)


def improved(content: Column, answer: Column, most: int = 2000, least: int = 50, keep_tail: bool = True) -> Column:
    """A model's text for the head of a content, with the tail put back (pages) or not (people); short contents stay."""
    whole = F.concat(answer, F.lit("\n\n"), T.tail(content, most)) if keep_tail else answer
    new = F.when(F.length(content) > most, whole).otherwise(answer)
    return F.when((F.length(content) < least) | T.blank(answer), content).otherwise(new)


def translated(content: Column, answer: Column) -> Column:
    """A translation where the text is mostly English and there is one; the text itself otherwise."""
    return F.when(T.mostly_english(content) & ~T.blank(answer), answer).otherwise(content)
