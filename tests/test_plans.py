"""Queries over small tables of their own."""

import json

from quarrymill.plans import registry


def ran(spark, folder, query, **tables):
    """The rows of a query; each table is given as its rows and schema."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return registry.QUERIES[query](spark, str(folder)).collect()


def test_texts_with_one_opening_are_not_copies(spark, tmp_path):
    opening = "the same forty characters at the opening "
    rows = [(1, opening + "a" * 400, "s"), (2, opening + "b" * 400, "s"), (3, opening + "a" * 400, "s"), (4, opening + "a" * 400, "t"), (5, opening, "s")]
    documents = (rows, "doc_id long, text string, source string")
    for query in ("dedup_mark_before", "dedup_mark_after"):
        assert sorted(r.doc_id for r in ran(spark, tmp_path, query, documents=documents)) == [1, 2, 4]


def test_pages_of_all_hosts_are_valid(spark, tmp_path):
    urls = [f"http://h{k:02d}.example.org/page" for k in range(30)] + ["http://h25.example.org/en/x", "http://h26.example.org/f.pdf", None]
    pages = ([(k, url, "") for k, url in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r.valid for r in ran(spark, tmp_path, "url_valid", pages=pages)}
    assert got == dict.fromkeys(range(30), True) | {30: False, 31: False, 32: None}


def test_union_has_all_sources(spark, tmp_path):
    rows = [(k, "x", f"src{k % 5}") for k in range(20)] + [(20, "x", None)]
    got = ran(spark, tmp_path, "union_of_sources", documents=(rows, "doc_id long, text string, source string"))
    assert sorted(got) == sorted((k, source) for k, _, source in rows)


def test_messages_are_whole_conversations(spark, tmp_path):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"), (1, 4, "assistant", "d")]
    rows += [(2, 0, "assistant", "hello"), (2, 1, "user", "e"), (3, 0, "assistant", "f"), (4, 0, "system", "g")]
    found = ran(spark, tmp_path, "chat_messages", conversations=(rows[::-1], "conv_id long, turn long, role string, text string"))
    got = {(r.conv_id, r.turn): [(m["role"], m["content"]) for m in json.loads(r.messages)] for r in found}
    first = [r[2:] for r in rows[:5]]
    assert got == {(1, 1): first[:3], (1, 3): first, (2, 1): [("assistant", "hello"), ("user", "e")], (3, 0): [("assistant", "f")], (4, 0): [("system", "g")]}


def test_every_vector_can_be_found_by_the_graph(spark, tmp_path):
    embeddings = ([(k, [1.0, 0.0], k % 2) for k in range(20)], "vec_id long, embedding array<double>, label int")
    for query in ("retrieve_local", "retrieve_mix"):
        assert sorted(r.chunk_id for r in ran(spark, tmp_path, query, embeddings=embeddings)) == list(range(20))
    for query in ("retrieve_global", "retrieve_hybrid"):
        assert {r.chunk_id for r in ran(spark, tmp_path, query, embeddings=embeddings)} >= {0, 2, 4}


def test_every_part_is_merged(spark, tmp_path):
    rows = [(k, f"n{k}", "b", None if k == 60 else k % 50 + 1, 1.0) for k in range(1, 61)]
    got = ran(spark, tmp_path, "upsert_merge", part=(rows, "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double"))
    assert sorted(r.code for r in got) == [f"CSC{1000 + k}" for k in range(1, 61)]
    assert {r.course_type for r in got} == {"required", "elective"}
