"""Operators on literal rows, and properties that hold for all."""

import json
import time

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.operators import chunking, pages, prompts, quality, ranking, records, retrieval, schemes
from quarrymill.sources import files, sinks
from quarrymill.streaming import incremental


def test_first_copy_counts_before_the_rules(spark):
    long = "字" * 150
    rows = [("f", 1, "u", "short", None), ("f", 2, "u", long, None), ("g", 1, "u", long, None), ("f", 3, "", long, None), ("f", 4, "v", "字" * 100, "述" * 30)]
    df = spark.createDataFrame(rows, "source_file string, line_no long, url string, content string, meta_description string")
    got = {(r.source_file, r.url): r.content for r in quality.clean_pages(df).collect()}
    assert set(got) == {("g", "u"), ("f", "v")} and got["f", "v"].startswith("述" * 30 + "\n\n")


@pytest.mark.parametrize(
    "text, want",
    [
        ("aaaa¶bbbb¶ccccc¶" + "d" * 25 + "¶e", ["aaaa¶bbbb", "ccccc", "d" * 10, "d" * 10, "d" * 5, "e"]), ("aaaa¶bbbbbb", ["aaaa", "bbbbbb"]),
        ("x" * 9 + "¶aaaa¶bbbbbb", ["x" * 9, "aaaa¶bbbbbb"]), ("", []), ("¶ ¶", []), ("d" * 20, ["d" * 10, "d" * 10]),
    ],
)
def test_packing(spark, text, want):
    df = spark.createDataFrame([(text.replace("¶", "\n\n"),)], "t string")
    assert df.select(chunking.packed(F.col("t"), 10).alias("p")).first().p == [w.replace("¶", "\n\n") for w in want]


def test_table_sentences(spark):
    tables = [("s", "f", 2, [["代码", ""], ["A", "B"], ["", ""]]), ("s", "f", 3, [["", None], ["x", "y"]]), ("s", "f", 4, [])]
    df = spark.createDataFrame(tables, "scheme string, faculty string, page_number int, rows array<array<string>>")
    got = [(r.page_number, r.row_idx, r.content) for r in chunking.table_sentences(df).orderBy("page_number", "row_idx").collect()]
    assert got == [
        (2, 1, "s（f）第2页表格：代码：A；列2：B"), (2, 2, "s（f）第2页表格：代码："), (3, 0, "s（f）第3页表格：列1：；列2："), (3, 1, "s（f）第3页表格：列1：x；列2：y"),
    ]


def test_extras(spark):
    df = spark.createDataFrame([("abcdefghij", "a b c d e")], "t string, w string")
    row = df.select(chunking.overlapping(F.col("t"), 4, 1).alias("o"), chunking.token_chunks(F.col("w"), 2).alias("k")).first()
    assert row.o == ["abcd", "defg", "ghij"] and row.k == ["a b", "c d", "e"]


def test_interleaving(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK", 2)
    rows = [("A", k) for k in (1, 2, 5)] + [("B", 1)] + [("C", k) for k in (3, 4)]
    df = spark.createDataFrame(rows, "source_file string, line_no long")
    got = ranking.interleaved(df, 1).orderBy("round", "file_ordinal", "place").collect()
    assert [(r.source_file, r.line_no) for r in got] == [("A", 1), ("B", 1), ("C", 3), ("A", 2), ("C", 4), ("A", 5)]


@pytest.mark.parametrize("n, k, want", [(100, 10, 20), (20, 10, 10), (1000, 100, 200), (5, 10, 10)])
def test_pool(n, k, want):
    assert ranking.pool_size(n, k) == want


def test_batches_and_gaps(spark):
    assert ranking.insert_batch() == 64 and ranking.insert_batch(128, 16) == 16
    df = spark.createDataFrame([("s", k, n) for k, n in enumerate((3, 0, 0, 1, 0, 0, 0, 5))], "site string, page_no int, n_links int")
    assert sorted(r.page_no for r in ranking.pages_before_gap(df).collect()) == [0, 1, 2, 3, 4, 5, 6]


def test_scheme_fields(spark):
    text = (
        "Minor Programme Title: Data   Science\n副修课程名称：数据科学\nApplicable to students admitted in 2023-24\nMajor Double Major\nTotal: 30\n12 units of School Package\n"
        "1. School Package: CSC1001 MAT1001\n2. Required Courses: CSC3100 STA2001H\n3. Elective Courses: 9 DDA4002\nNotes:\n[a] a note of length\n[b] tiny\n"
    )
    c = F.col("t")
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        schemes.programme(c).alias("p"), schemes.requirements(c).alias("r"), schemes.codes(c).alias("codes"), schemes.notes(c).alias("notes"),
        schemes.section_courses(c, "elective").alias("e"), schemes.units(F.lit("3 Units")).alias("u"),
    ).first()
    assert (row.p.programme_name_en, row.p.programme_name_zh, row.p.applicable_years, row.p.programme_type) == ("Data Science", "：数据科学", "2023-24", "minor")
    assert row.r.total_units == 30 and row.r.school_package_units == 12 and row.codes == ["CSC1001", "CSC3100", "DDA4002", "MAT1001", "STA2001H"]
    assert row.notes == ["[a] a note of length"] and [(x.code, x.level, x.course_type) for x in row.e] == [("DDA4002", 4000, "elective")] and row.u == 3
    assert spark.createDataFrame([("课程CSC3100介绍 MAT1001",)], "t string").select(schemes.codes(c).alias("v")).first().v == ["MAT1001"]
    assert schemes.scheme_record(df.withColumn("scheme", F.lit("x")), "t").count() == 1


def test_streams(spark):
    text = "students are divided into streams: \ni) data mining stream\nii) machine vision stream\niii) first year stream\nStudents may choose"
    df = spark.createDataFrame([(text,), ("i) Data Mining Stream\nii) 金融科技 方向\n(1) Actuarial Science; (2) Big Data",)], "t string")
    got = [[(s.name_en, s.name_zh) for s in r.v] for r in df.select(schemes.streams(F.col("t")).alias("v")).collect()]
    assert got[0] == []  # the introduction's pattern takes no Latin letters, in either case
    assert ("Data Mining Stream", None) in got[1] and (None, "金融科技") in got[1] and ("Actuarial Science", None) in got[1]
    both = spark.createDataFrame([("none", [[["i) Data Mining Stream", None]]])], "t string, tables array<array<array<string>>>")
    assert both.select(schemes.streams_of(F.col("t"), F.col("tables")).alias("v")).first().v[0].name_en == "Data Mining Stream"


def test_table_courses_and_merge(spark):
    rows = [["Course Code", "Title (English)", "Units"], ["CSC 1001", "Intro", "3 u"], ["bad", "x", "1"], ["MAT2001", "", None]]
    tables = spark.createDataFrame([("s", rows)], "scheme string, rows array<array<string>>")
    tabled = schemes.table_courses(tables)
    assert sorted((r.code, r.name_en, r.units, r.level) for r in tabled.collect()) == [("CSC1001", "Intro", 3, 1000), ("MAT2001", None, None, 2000)]
    listed = spark.createDataFrame([("s", "CSC1001", 2, "required", None, None, None, 1000)], "scheme string, code string, list_no int, course_type string, name_en string, name_zh string, units int, level int")
    got = {r.code: (r.course_type, r.name_en, r.units) for r in schemes.merged_courses(listed, tabled).collect()}
    assert got == {"CSC1001": ("required", "Intro", 3), "MAT2001": ("elective", None, None)}


def test_courses(spark):
    df = spark.createDataFrame([("C1", "T", None, "", "3", None, None, None, None, "u", "d", None)], "code string, title string, level string, school string, credits string, grading string, teaching_mode string, term string, category string, url string, description string, content string")
    assert df.select(records.course_content().alias("v")).first().v == "课程代码：C1\n课程名称：T\n学分：3\n\n\n课程描述：\nd"
    assert df.select(records.course_content_flat().alias("v")).first().v == "学分：3\n课程链接：u\n\n课程描述：\nd"
    assert records.course_documents(df.withColumn("content", F.lit("a b"))).first().title == "C1 - T" and records.course_documents_flat(df).first().title == "C1 T"
    row = df.select(records.course_title(F.lit(None), F.lit(""), " ").alias("t"), records.index_text(F.lit("t"), F.lit("c")).alias("i"), records.index_text(F.lit(""), F.lit("c")).alias("j")).first()
    assert tuple(row) == ("未知课程", "标题: t\n\nc", "c")


def test_people(spark):
    df = spark.createDataFrame([("p", 0, None, "home"), ("p", 1, "Tab", "text")], "person string, ord int, name string, text string")
    assert records.merged_sections(df, ["person"]).first().content == "home\n\n=== Tab ===\ntext"
    path = spark.createDataFrame([("file:/a/fac/scheme one.pdf",)], "p string")
    assert tuple(records.lineage(path, F.col("p")).first())[1:] == ("fac", "scheme one")


def test_messages(spark):
    df = spark.sql("SELECT array(named_struct('role','user','content','q')) m, array(named_struct('role','user','content','h')) h")
    row = df.select(prompts.assembled(F.col("m"), F.lit("s"), F.col("h")).alias("a"), prompts.assembled(F.col("m"), F.lit(None), F.col("h")).alias("b")).first()
    assert [m.content for m in row.a] == ["s", "h", "q"] and [m.content for m in row.b] == ["h", "q"]
    long = spark.sql("SELECT array(named_struct('role','user','content',repeat('x', 50000)), named_struct('role','user','content',repeat('y', 50000))) m")
    assert [len(m.content) for m in long.select(prompts.guarded(F.col("m")).alias("m")).first().m] == [50000, 50000]
    longer = spark.sql("SELECT array(named_struct('role','user','content',repeat('x', 70000)), named_struct('role','user','content','y')) m")
    got = longer.select(prompts.guarded(F.col("m")).alias("m")).first().m
    assert got[0].content == "x" * 60000 + "\n\n[内容已截断...]" and got[1].content == "y"
    assert spark.sql("SELECT map('a', '1', 'extra_body', '2') p").select(prompts.sent_parameters(F.col("p")).alias("p")).first().p == {"a": "1"}


@pytest.mark.parametrize(
    "raw, status, n",
    [
        ('{"qas": [{"question": "q", "answer": "a"}]}', "ok", 1), ('```json\n{"skip": true}\n```', "skip", 0), ('```\n{"qas": []}\n```', "error", 0), ("", "error", 0),
        ('{"qas": {"a": 1}}', "error", 0), ('[1]', "error", 0), ('{"skip": false, "qas": [{"question": "q", "answer": ""}, 3]}', "error", 0),
    ],
)
def test_answers(spark, raw, status, n):
    row = spark.createDataFrame([(raw,)], "r string").select(prompts.qa_answers(F.col("r")).alias("v")).first().v
    assert row.status == status and len(row.qas) == n and (row.reason == prompts.POOR) == (status == "skip")


def test_model_calls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "k int, p string")
    got = {r.k: r.answer for r in prompts.completed(df, "p", lambda ps: ["SHORT" if p == "bad" else p * 3 for p in ps], accept=lambda s: s != "SHORT").collect()}
    assert got == {1: "aaa", 2: None, 3: None}
    row = spark.createDataFrame([("x" * 2100, "new")], "c string, a string").select(prompts.improved(F.col("c"), F.col("a")).alias("v"), prompts.improved(F.col("c"), F.col("a"), keep_tail=False).alias("w")).first()
    assert row.v == "new\n\n" + "x" * 100 and row.w == "new"
    good = spark.createDataFrame([('{"title": " t ", "content": "c"}',), ('{"title": ""}',)], "r string").select(prompts.scheme_answer(F.col("r")).alias("v")).collect()
    assert good[0].v.title == "t" and good[1].v is None


def test_page_fields():
    html = "<html><head><title></title><meta name=description content=' d '></head><body><h1>Name</h1><main>short</main><article>" + "w " * 40 + "<a href='/p?page=7#x'>next</a><a href='y'></a></article><p>" + "z" * 30 + " a@b.cd</p><script>no</script><ul class=pager><li>12</ul><a href='//me.org/'>Homepage</a></body></html>"
    got = pages.page_fields(html, "http://a.org/x/")
    assert got["title"] == "" and got["meta_description"] == "d" and got["content"].startswith("w w") and got["max_page"] == 12
    assert got["links"][0] == {"text": "next", "url": "http://a.org/p?page=7"} and got["person"]["email"] == "a@b.cd" and got["person"]["site"] == "http://me.org"
    assert got["paragraphs"] == ["z" * 30 + " a@b.cd"] and got["person"]["name"] == "Name"
    assert pages.page_fields(None, None)["content"] == "" and "deep" in pages.page_fields("<div>" * 3000 + "deep", "")["content"]


def test_frontier(spark):
    web = {"http://a.org": ["http://a.org/1", "http://a.org/2", "http://b.org"], "http://a.org/1": ["http://a.org", "http://a.org/3"], "http://a.org/2": ["http://a.org/3"], "http://a.org/3": ["http://a.org/4"], "http://a.org/4": []}
    table = spark.createDataFrame([(u, [(x, x) for x in links]) for u, links in web.items()], "url string, links array<struct<text:string,url:string>>")
    start = spark.createDataFrame([("http://a.org",)], "url string")
    got = pages.frontier(start, lambda urls: table.join(urls, "url"), ["a.org"], 2, 100)
    assert sorted((r.url, r.round) for r in got.collect()) == [("http://a.org", 0), ("http://a.org/1", 1), ("http://a.org/2", 1), ("http://a.org/3", 2)]
    assert pages.frontier(start, lambda urls: table.join(urls, "url"), ["a.org"], 9, 3).count() == 3


def test_retrieval(spark):
    rows = spark.createDataFrame([(k, [float(k % 3), 1.0]) for k in range(9)], "vec_id long, embedding array<float>").repartition(3)
    assert [r.vec_id for r in retrieval.top_k(rows, [1.0, 0.0], 2).collect()] == [2, 5]
    questions = spark.createDataFrame([(7, [1.0, 0.0]), (8, [-1.0, 0.0])], "q_id long, q_vector array<float>")
    got = sorted((r.q_id, r["rank"], r.vec_id) for r in retrieval.top_k_each(rows, questions, 2).collect())
    assert got == [(7, 1, 2), (7, 2, 5), (8, 1, 0), (8, 2, 3)]
    assert retrieval.top_k_each(rows, questions.limit(0), 2).collect() == []
    vectors = retrieval.embedded(spark.createDataFrame([(1, "ab"), (2, None)], "k int, t string"), "t", lambda ts: [[len(t) * 3.0, len(t) * 4.0] for t in ts]).collect()
    assert [[round(x, 3) for x in r.embedding] for r in vectors] == [[0.6, 0.8], [0.0, 0.0]]
    with pytest.raises(ValueError):
        retrieval.retrieve("other", [1.0], rows, rows, rows)


def test_tolerant_lines(spark, tmp_path):
    lines = ['{"title": "t", "content": "c"}', "", "{bad", '{"content": ""}', "[1]", '{"content": "d"}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines), encoding="utf-8")
    rows = files.numbered_lines(spark, str(tmp_path))
    assert sorted(r.line_no for r in rows.collect()) == [1, 2, 3, 4, 5, 6]
    got = sorted((r.line_no, r.title, r.url) for r in files.read_index_input(spark, str(tmp_path)).collect())
    assert got == [(1, "t", ""), (6, "未知标题", "")]
    offsets = rows.select("source_file").distinct().withColumn("line_offset", F.lit(2))
    assert sorted(r.line_no for r in ranking.after_offsets(rows, offsets).collect()) == [3, 4, 5, 6]


def test_json_files_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('[{"title": "一", "content": null}, {"title": "b"}]', encoding="utf-8")
    schema = files.SCHEMAS["index_input"]
    rows = files.read_json_array(spark, str(tmp_path / "in"), schema)
    assert rows.count() == 2
    sinks.write_jsonl(rows.coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part*"))
    assert json.loads(text.splitlines()[0]) == {"title": "一", "content": None, "url": None} and "一" in text
    sinks.by_input(rows.withColumn("source_file", F.lit("x/a.json")), str(tmp_path / "by"))
    assert (tmp_path / "by/input=a.json").exists()
    (tmp_path / "obj").mkdir()
    for name in "ab":
        (tmp_path / f"obj/{name}.json").write_text('{\n"title": "%s"}' % name, encoding="utf-8")
    assert [r.title for r in files.read_json_objects(spark, str(tmp_path / "obj"), schema, 1).collect()] == ["a"]
    assert files.decoded(("中文网页" * 60).encode("gbk")) == "中文网页" * 60 and files.decoded("中文".encode()) == "中文"


def test_encodings_are_looked_for_in_longer_texts_alone():
    long = "中文网页" * 60
    assert "�" in files.decoded("中文网页".encode("gbk"))
    assert files.decoded(long.encode("big5", "ignore") * 3, lambda raw: "big5").startswith("中文")
    assert files.decoded(long.encode("gbk"), lambda raw: None).count("�") > 50
    assert files.decoded(("é" * 200).encode(), lambda raw: "UTF-8") == "é" * 200 and files.decoded(None) == ""


def test_frontier_goes_on_where_it_ended(spark, tmp_path):
    web = {f"http://a.org/{k}": [f"http://a.org/{2 * k + 1}", f"http://a.org/{2 * k + 2}"] for k in range(31)}
    table = spark.createDataFrame([(u, [(x, x) for x in links]) for u, links in web.items()], "url string, links array<struct<text:string,url:string>>")
    start, asked = spark.createDataFrame([("http://a.org/0",)], "url string"), []

    def fetch(urls):
        asked.extend(r.url for r in urls.collect())
        return table.join(urls, "url")

    whole = {r.url: r.round for r in pages.frontier(start, fetch, ["a.org"], 3, 100).collect()}
    assert len(whole) == 15
    asked.clear()
    assert pages.frontier(start, fetch, ["a.org"], 1, 100, str(tmp_path / "s")).count() == 3
    assert pages.frontier(start, fetch, ["a.org"], 2, 5, str(tmp_path / "s")).count() == 5
    again = pages.frontier(start, fetch, ["a.org"], 9, 15, str(tmp_path / "s"))
    assert sorted(r.url for r in again.collect()) == sorted(set(asked)) and len(asked) == 15 and asked[:3] == ["http://a.org/0", "http://a.org/1", "http://a.org/2"]


LIST = """<html><body><nav><a href="/zh/teacher/nav">Nav Name</a></nav><div id="x"><a href="/zh/teacher/9">Out Side</a></div>
<main><div class="teacher-list big"><a href="/zh/teacher/2?x=1">Ann Lee</a></div><ul><li><a href="/zh/teacher/1">Bob Ray</a></li><li><a href="/zh/teacher/2">Ann Lee</a></li></ul></main></body></html>"""


def test_list_links_come_by_places(spark):
    root = pages.parse(LIST)
    got = [u for _, u in pages.list_links(root, "http://a.org/l")]
    # Each place's links in turn: the class, classes with "teacher" in them, list items, then all of main.
    a = "http://a.org/zh/teacher/"
    assert got == [f"{a}2?x=1", f"{a}2?x=1", f"{a}1", f"{a}2", f"{a}2?x=1", f"{a}1", f"{a}2"]
    assert [u for _, u in pages.area_links(root, "http://a.org/l")] == [f"{a}2?x=1", f"{a}1", f"{a}2"]
    rows = [(1, "http://a.org/l", LIST), (2, "http://a.org/l", '<div id="content"><a href="/zh/teacher/5">Eve Fox</a></div><a href="/zh/teacher/6">Far Off</a>'), (3, None, None)]
    fields = pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"), "list_links", "area_links")
    assert [(r.page_id, r.url) for r in pages.person_links(fields).orderBy("page_id", "pos").collect()] == [(1, f"{a}2?x=1"), (1, f"{a}1"), (2, f"{a}5")]


def test_page_numbers_and_titles():
    assert pages.most_page(pages.parse('<a href="?page=12345678901">x</a>')) == 12345678901
    assert pages.most_page(pages.parse('<div class="pager">1 2 30 1001 00040</div>')) == 40
    assert pages.title(pages.parse("<title>" + "café crème brûlée".encode().decode("latin-1") + "</title>")) == "café crème brûlée"


def test_back_off_and_conversion(spark):
    rows = spark.createDataFrame([("a",), (None,)], "prompt string").coalesce(1)
    began = time.time()
    got = prompts.completed(rows, "prompt", lambda asked: [None] * len(asked), tries=3, wait=0.2).collect()
    assert time.time() - began >= 0.6 and [r.answer for r in got] == [None, None]
    assert [r[0] for r in rows.select(T.converted(F.col("prompt"), str.upper)).collect()] == ["A", None]


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good = "字" * 150

    def write(name, *urls):
        (source / name).write_text("\n".join(json.dumps({"url": u, "content": good, "title": "t"}) for u in urls), encoding="utf-8")

    def run():
        incremental.clean_stream(spark, str(source), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return sorted(r.url for r in spark.read.json(str(tmp_path / "out/cleaned")).collect())

    write("a.json", "u1", "u2", "u1")
    assert run() == ["u1", "u2"]
    write("b.json", "u2", "u3")
    assert run() == ["u1", "u2", "u3"]
