import hashlib
import json
import random

import pytest

from quarrymill.llm import substring


def brute(rows, window):
    """Straight from the definition, on word lists."""
    seen = {}
    for doc_id, words in rows:
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if doc_id is not None:
                seen[key] = min(doc_id, seen.get(key, doc_id))
    out = []
    for doc_id, words in rows:
        gone = set()
        for k in range(len(words) - window + 1):
            if doc_id is not None and seen[tuple(words[k : k + window])] < doc_id:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted(rng, n, vocabulary):
    word = lambda: rng.choice(vocabulary)
    passages = [[word() for _ in range(size)] for size in (49, 50, 51, 80, 120)]
    texts = []
    for _ in range(n):
        words = [word() for _ in range(rng.choice((0, 5, 49, 50, 60, 200)))]
        for _ in range(rng.choice((0, 0, 1, 2))):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        texts.append(rng.choice((" ", "\n", "\t ")).join(words))
    return texts + texts[: n // 5]


@pytest.mark.parametrize("vocabulary", [["a", "b", "é"], [f"w{k}" for k in range(3000)]])
def test_same_as_brute_force(spark, vocabulary):
    rng = random.Random(len(vocabulary))
    texts = planted(rng, 60, vocabulary)
    rows = [(k, t) for k, t in zip(rng.sample(range(1000), len(texts)), texts)]
    rows += [(None, rows[0][1]), (None, None), (2000, None), (2001, " ".join(["x"] * 300)), rows[3]]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, at string")
    got = substring.removal_digests(docs)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == brute([(i, (t or "").encode().split()) for i, t in rows], 50)


def test_spans_and_text(spark):
    same = " ".join(f"s{k}" for k in range(60))
    docs = spark.createDataFrame([(1, same), (2, f"a {same} b"), (1, "other")], "doc_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in substring.remove_repeats(docs).collect()}
    assert got[2, 62].kept == "a b" and json.loads(got[2, 62].spans) == [[1, 61]]
    assert got[1, 60].n_removed == 0 and got[1, 1].kept == "other"


def test_empty_table(spark):
    assert substring.removal_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "x " * 300_000, "\n".join(f"w{k % 60}" for k in range(200_000))])
def test_long_texts(spark, text):
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "short")], "doc_id long, text string")
    got = {r.doc_id: r for r in substring.removal_digests(docs).collect()}
    n = len(text.split())
    assert [(got[k].n_words, got[k].n_removed) for k in (1, 2)] == [(n, 0), (n + 1, n if n >= 50 else 0)]
