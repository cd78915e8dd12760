import random
import re
import time

import numpy as np
import pytest

from quarrymill.llm import decontam


def shingles(text, n):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    n = min(n, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set(), n


def brute(docs, items, n=5, least=0.8):
    out = []
    for doc_id, text in docs:
        for item, question in items:
            want, length = shingles(question, n)
            shared = len(want & shingles(text, length)[0]) if want else 0
            if want and shared >= least * len(want):
                out.append((doc_id, item, len(want), shared, shared / len(want)))
    return sorted(out, key=str)


def test_same_as_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(4000)]
    draw = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    items = [(k, " ".join(draw(rng.choice((1, 3, 5, 8, 14, 30, 59, 100))))) for k in range(60)]
    items += [(100, None), (101, ""), (102, "..."), (103, items[0][1])]
    docs = []
    for k in range(150):
        words = draw(rng.choice((0, 4, 50, 700, 3000)))
        for _ in range(rng.choice((0, 1, 2))):
            passage = rng.choice(items[:60])[1].upper().split()
            for _ in range(rng.choice((0, 0, 1))):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = ", ".join(passage).split() if rng.random() < 0.5 else passage
        docs.append((k, " ".join(words)))
    docs += [(None, items[20][1]), (900, None), docs[1]]
    want = brute(docs, items)
    assert len(want) > 50
    found = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, decontam.contamination(found, tests).collect()), key=str) == want
    monkeypatch.setattr(decontam, "ITEMS", 25)
    assert sorted(map(tuple, decontam.contamination(found, tests).collect()), key=str) == want
    held = {d for d, *_ in want if d is not None}
    kept = [r.doc_id for r in decontam.clean_documents(found, tests).collect()]
    assert sorted(kept, key=str) == sorted((d for d, _ in docs if d is not None and d not in held), key=str)


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "other words"), (None, "x A b, c d E f"), (None, "clean")], "doc_id long, text string")
    tests = spark.createDataFrame([("q", "a b c d e f")], "item_id string, text string")
    assert sorted(r.text for r in decontam.clean_documents(docs, tests).collect()) == ["clean", "other words"]
    assert sorted((str(r.doc_id), r.item_id) for r in decontam.contamination(docs, tests).collect()) == [("1", "q"), ("None", "q")]


def test_blocks_are_those_with_hits():
    rng = np.random.default_rng(1)
    for n, size in ((1, 1), (1, 8), (37, 4), (300, 64), (1000, 1)):
        hashes = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        hits = np.flatnonzero(rng.random(n) < 0.1)
        got = np.concatenate([np.zeros(0, np.uint64), *decontam.block_minima(hashes, hits, size)]) if len(hits) else np.zeros(0, np.uint64)
        want = set()
        for k in range(max(1, -(-n // size) - 1)):
            if any(k * size <= h < (k + 2) * size for h in hits):
                want.update(decontam.signature(hashes[k * size : (k + 2) * size]).tolist())
        assert set(got.tolist()) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    tests = spark.createDataFrame([(7, "a b c d e f")], "item_id long, text string")
    assert decontam.contamination(docs, tests.limit(0)).collect() == []
    assert decontam.contamination(docs.limit(0), tests).collect() == []
    assert decontam.clean_documents(docs, tests).collect() == []


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "1" * 1_000_000, "." * 1_000_000, "a b c d e f " * 150_000, "w " * 500_000])
def test_long_texts_take_no_longer_than_their_length(text):
    search = decontam.Search([(1, "a b c d e f"), (2, "q"), (3, "w w w w w w"), (4, " ".join(f"x{k}" for k in range(500)))], 5, 0.8)
    began = time.time()
    list(search.held(text))
    assert time.time() - began < 15


def test_an_item_anywhere_in_a_long_text():
    rng = random.Random(5)
    item = [f"i{k}" for k in range(40)]
    words = [f"w{rng.randrange(1000)}" for _ in range(300_000)]
    for at in (0, 131_070, 299_950):
        whole = words[:at] + item + words[at:]
        search = decontam.Search([(7, " ".join(item)), (8, "i1 i2 i3")], 5, 0.8)
        assert [x[0] for x in search.held(" ".join(whole))] == [7, 8]
