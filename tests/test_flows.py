"""The flows with models that are plain functions."""

import json

import pytest

from quarrymill.config import Settings
from quarrymill.operators import pages
from quarrymill.plans import flows, registry

BODY = "学校介绍" * 40


def test_clean_raw(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"url": "a", "content": BODY, "meta_description": "述"}, {"url": "a", "content": BODY}, {"url": "b", "content": "x"}]
    (tmp_path / "in/s.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\nbad\n")
    report = flows.clean_raw(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()
    assert (report.total, report.kept, report.kept_percent) == (3, 1, 33.33)
    got = spark.read.json(str(tmp_path / "out")).first()
    assert got.content == f"述\n\n{BODY}" and got.input == "s.jsonl" and "meta_description" not in got


def test_page_and_person_documents(spark):
    df = spark.createDataFrame([("t", BODY, "u", 1, "now"), ("skipped", BODY, "v", 1, "now"), ("", BODY, "w", 1, "now"), ("t", "短", "x", 1, "now")], "title string, content string, url string, depth int, crawl_time string")
    got = flows.page_documents(df, lambda ps: [None if "x" in p else p + "。" for p in ps], lambda ps: ["SKIP" if p.startswith("skipped") else '"好"' for p in ps]).collect()
    assert [(r.title, r.url, r.metadata.source_title) for r in got] == [("好", "u", "t")] and got[0].content == BODY + "。"
    people = spark.createDataFrame([("t", BODY + "教授", "u", ("李",)), ("入学申请", BODY + "教授", "v", ("",)), ("t", BODY, "w", ("",))], "title string, content string, url string, teacher_info struct<name:string>")
    got = flows.person_documents(people, lambda ps: list(ps), lambda ps: ["李教授"] * len(ps)).collect()
    assert [(r.title, r.url) for r in got] == [("李教授", "u")]


def test_courses_and_schemes(spark):
    names = "code title level school credits grading teaching_mode term category url description content".split()
    rows = [(1, "C1", "t", *[None] * 7, "u", "An English description of it. " * 3, None), (2, "C1", "again", *[None] * 7, "u", BODY, None), (3, "", "", *[None] * 7, "", BODY, None)]
    df = spark.createDataFrame(rows, "line_no long, " + ", ".join(f"{n} string" for n in names))
    got = flows.course_documents(df, lambda ps: [BODY for _ in ps]).collect()
    assert [(r.title, r.metadata.code) for r in got] == [("C1 - t", "C1")] and BODY in got[0].content
    scheme = spark.createDataFrame([("s", 2, "3. Elective Courses: CSC3001\nNotes"), ("s", 1, "Programme Title: X")], "scheme string, page_number int, text string")
    seen = flows.scheme_documents(scheme, lambda ps: ['{"title": "T", "content": "%d"}' % ("CSC3001" in p and '"X"' in p) for p in ps]).first()
    assert (seen.scheme, seen.title, seen.content) == ("s", "T", "1")


def test_questions_and_index(spark):
    df = spark.createDataFrame([(k, f"t{k}", f"u{k}", f"{BODY} word{k} and{k}", 3) for k in range(30)], "doc_id long, title string, url string, content string, word_count int")
    answers = lambda ps: ['{"qas": [{"question": "q", "answer": "a"}]}' for _ in ps]
    got = flows.question_answers(df, answers, "doc_id", settings=Settings(sample_size=5)).collect()
    assert len(got) == 5 and got[0].answer_type == "other" and got[0].source.url.startswith("u")
    embed = lambda ts: [[float("word7 " in t + " "), 1.0] for t in ts]
    chunks = flows.index_chunks(df, embed)
    out = flows.answer("word7 ?", chunks, embed, lambda p: p.splitlines()[-1], Settings(top_k=1))
    assert "word7" in out["context"][0]["content"] and out["answer"] == "word7 ?"


def test_settings(monkeypatch):
    monkeypatch.setenv("QUARRYMILL_TOP_K", "9")
    monkeypatch.setenv("QUARRYMILL_TOP_RATIO", "1.5")
    assert (Settings.from_env().top_k, Settings.from_env().top_ratio, Settings().top_k) == (9, 1.5, 5)


def test_lists(spark):
    df = spark.createDataFrame([("http://a", 3)], "base string, max_page int")
    assert [r.url for r in flows.list_pages(df).orderBy("page_no").collect()] == ["http://a", "http://a?keywords=&page=2", "http://a?keywords=&page=3"]
    html = "<ul><li><a href='/people/li?x=1'>李明</a><li><a href='/people/li'>李明</a><li><a href='/news/x'>新闻</a></ul>"
    page = pages.extracted(spark.createDataFrame([(1, "http://a.org/zh", html)], "page_id long, url string, html string"))
    assert [(r.pos, r.url) for r in pages.person_links(page).collect()] == [(0, "http://a.org/people/li?x=1")]


@pytest.mark.parametrize("name", ["clean_report_by_source", "interleave_sources", "upsert_merge"])
def test_plans_have_no_cartesian_product_or_python(spark, name):
    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan and "MapInArrow" not in plan


def test_scan_reads_what_is_used(spark):
    plan = registry.QUERIES["round_robin_shards"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan
