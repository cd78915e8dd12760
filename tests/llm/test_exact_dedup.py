import hashlib
import random
import re

from quarrymill.llm import exact_dedup

SCHEMA = "doc_id long, text string, norm string, row long, content_hash string"


def frame(spark, rows):
    """With further columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, "n", k, "h") for k, r in enumerate(rows)], SCHEMA)


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def drawn(rng, n):
    texts = ["a b", "a  b", "a\tb", "a b", "A b", "", None, " ", "\n\n", "x" * 3000, " a b"]
    return [(rng.choice((None, *range(20))), rng.choice(texts)) for _ in range(n)]


def test_verdicts_are_those_of_a_loop(spark):
    rows = drawn(random.Random(1), 200)
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    want = []
    for doc_id, text in rows:
        ids = groups[normal(text)]
        keep = min((i for i in ids if i is not None), default=None)
        want.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(normal(text).encode()).hexdigest()))
    got = exact_dedup.exact_duplicates(frame(spark, rows).repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_one_row_of_each_text_stays(spark):
    rows = drawn(random.Random(2), 150)
    docs = frame(spark, rows).repartition(5)
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes)
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append((doc_id is None, doc_id or 0, text or ""))
    kept = sorted((normal(r.text), r.doc_id) for r in got.collect())
    assert kept == sorted((k, None if min(v)[0] else min(v)[1]) for k, v in groups.items())
    known = {(r[0], r[1], k) for k, r in enumerate(rows)}
    assert all((r.doc_id, r.text, r.row) in known and r.norm == "n" for r in got.collect())  # rows stay whole


def test_null_ids_and_ids_with_two_texts(spark):
    rows = [(None, "only here"), (None, "shared text"), (1, "shared text"), (5, "A a"), (5, "shared text")]
    got = exact_dedup.drop_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("1", "shared text"), ("5", "A a"), ("None", "only here")]


def test_empty_table(spark):
    assert exact_dedup.drop_duplicates(frame(spark, [(1, "a")]).limit(0)).collect() == []
    assert exact_dedup.exact_duplicates(frame(spark, [(1, "a")]).limit(0)).collect() == []
