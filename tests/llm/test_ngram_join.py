import random

import pytest

from quarrymill.llm import ngram_join


def brute(rows, n=3):
    """All pairs of sets, and a union-find over them."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        k = min(n, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    ids = [r[0] for r in rows]
    up = {i: i for i in ids if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            if None not in (ids[x], ids[y]) and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 90 * len(sets[x] | sets[y]):
                a, b = sorted((root(ids[x]), root(ids[y])))
                up[b] = a
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in zip(ids, sets)), key=str)


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(words) + 1)
        if kind == 0:
            words.insert(at, rng.choice(vocabulary))
        elif at < len(words) > 1 and kind == 1:
            del words[at]
        elif at < len(words):
            words[at] = rng.choice(vocabulary)
    return words


@pytest.mark.parametrize("seed, vocabulary", [(1, 40), (2, 2000), (3, 3)])
def test_same_as_brute_force(spark, seed, vocabulary):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(vocabulary)]
    texts = []
    for size in (1, 2, 9, 11, 12, 30, 60, 150, 400):
        base = [rng.choice(vocabulary) for _ in range(size)]
        texts += [edited(rng, base, rng.choice((0, 0, 1, 1, 2, 3, 6, 10)), vocabulary) for _ in range(14)]
        chain = base  # each a copy of the last one
        for _ in range(6):
            chain = edited(rng, chain, 1, vocabulary)
            texts.append(chain)
    passage = [f"p{k}" for k in range(30)]
    texts += [passage + [rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 40)))] for _ in range(20)]
    rows = list(zip(rng.sample(range(5000), len(texts)), (" ".join(t) for t in texts)))
    rows += [(6001, None), (6002, ""), (6003, " \n"), (6004, rows[0][1].upper()), (None, rows[5][1]), rows[7]]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, node int").repartition(3)
    assert sorted(map(tuple, ngram_join.near_copies(docs).collect()), key=str) == brute(rows)


def test_ids_with_two_texts_and_empty_tables(spark):
    long = " ".join(f"a{k}" for k in range(40))
    rows = [(1, long), (1, "other words than those are these"), (2, long + " x"), (3, "other words than those are these")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.near_copies(docs).collect()} == {1: 1, 2: 1, 3: 1}
    assert ngram_join.near_copies(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "x " * 300_000, " ".join(f"w{k}" for k in range(100_000))])
def test_long_texts(spark, text):
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "short one here")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.near_copies(docs).collect()}
    assert got == {1: 1, 2: 1 if len(set(text.split())) > 1000 else 2, 3: 3}


def test_large_buckets_are_dealt_by_size(spark, monkeypatch):
    """Passages that many documents share, in buckets over and under MANY, and copies of most of the documents."""
    rng = random.Random(12)
    passage = [f"p{k}" for k in range(60)]
    texts = [passage + [f"u{rng.randrange(9)}" for _ in range(rng.randrange(1, 12))] for _ in range(90)]
    texts += [[f"v{k}" for k in range(50)][: rng.randrange(40, 50)] for _ in range(30)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    for many in (2, 64):
        monkeypatch.setattr(ngram_join, "MANY", many)
        assert sorted(map(tuple, ngram_join.near_copies(docs).collect()), key=str) == want


def test_dropping_keeps_rows_whole(spark):
    rng = random.Random(13)
    base = [f"b{k}" for k in range(80)]
    rows = [(k, " ".join(base[:79] + [f"e{k}"]), f"s{k}") for k in range(10, 20)] + [(10, "another text altogether", "t"), (None, " ".join(base), "n"), (5, None, "x"), (6, "", "y")]
    docs = spark.createDataFrame([(r[0], r[1], r[2], 7) for r in rng.sample(rows, len(rows))], "doc_id long, text string, source string, sign_of_row int")
    got = ngram_join.drop_near_copies(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.source, r.sign_of_row) for r in got.collect()) == [("10", "s10", 7), ("10", "t", 7), ("5", "x", 7), ("6", "y", 7), ("None", "n", 7)]
