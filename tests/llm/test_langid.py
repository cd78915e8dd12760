import itertools
import random
import time
import zlib

import numpy as np
import pytest

from quarrymill.llm import langid

SOUNDS = {"aa": ["ba", "lo", "ri", "ma"], "bb": ["tch", "kr", "ung", "ze"], "cc": ["ño", "ción", "que", "ll"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def field():
    rng = random.Random(1)
    return langid.learn([(lang, text(rng, lang, 60).split()) for lang in SOUNDS for _ in range(80)])


def brute(field, words):
    """Marginals from the sum over every labelling."""
    scores = field.emissions(words).astype(float)
    total = np.zeros((len(words), len(field.langs)))
    for path in itertools.product(range(len(field.langs)), repeat=len(words)):
        s = field.start[path[0]] + sum(scores[t, k] for t, k in enumerate(path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:]))
        for t, k in enumerate(path):
            total[t, k] += np.exp(s)
    return total / total.sum(axis=1, keepdims=True)


def test_marginals_are_those_of_all_labellings(field):
    rng = random.Random(2)
    texts = [text(rng, lang, n).split() for lang, n in (("aa", 1), ("bb", 5), ("cc", 3), ("aa", 7))] + [[]]
    got = dict(langid._Labeller(field).probabilities(texts, True))
    assert set(got) == {0, 1, 2, 3}
    for k, p in got.items():
        assert np.allclose(p, brute(field, texts[k]), atol=1e-4)


def test_gradient(field):
    rng = np.random.default_rng(3)
    small = langid.Crf(["x", "y"], np.zeros((1, 2)), rng.normal(size=2), rng.normal(size=(2, 2)), {})
    scores, label, full = rng.normal(size=(1, 4, 2)), np.array([[0, 1, 1, 0]]), np.ones((1, 4), bool)

    def likelihood(m):
        value = lambda p: small.start[p[0]] + sum(scores[0, t, k] for t, k in enumerate(p)) + sum(m[a, b] for a, b in zip(p, p[1:]))
        return value(label[0]) - np.log(sum(np.exp(value(p)) for p in itertools.product(range(2), repeat=4)))

    got = langid._gradient(small, scores, label, full)[1]
    for a, b in itertools.product(range(2), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        assert abs((likelihood(small.moves + step) - likelihood(small.moves - step)) / 2e-5 - got[a, b]) < 1e-6


def test_switched_text(spark, field):
    rng = random.Random(4)
    mixed = text(rng, "aa", 20) + " " + text(rng, "bb", 20)
    row = langid.label_words(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), field).first()
    assert sum(a == b for a, b in zip(row.langs, ["aa"] * 20 + ["bb"] * 20)) >= 36


def test_held_out_rows_and_odd_texts(spark):
    rng = random.Random(5)
    rows = [(k, text(rng, lang, 40), lang) for k, lang in enumerate(list(SOUNDS) * 60)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 ²³ !", "cc"), (903, text(rng, "cc", 3000), None), (None, text(rng, "aa", 9), "aa"), rows[3]]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in langid.language_report(docs).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got if i is not None)
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:180]) and got[903].lang_pred == "cc" and got[None].lang_pred == "aa"
    assert {(got[i].lang_pred, got[i].score) for i in (900, 901, 902)} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.accepted(docs).count() == len(rows) - 3
    assert langid.language_report(docs.limit(0)).collect() == []


def test_accepted_keeps_switched_texts_and_rows_without_ids(spark):
    rng = random.Random(7)
    own = {"en": "the house garden river window apple", "fr": "être façon élève rivière fenêtre maçon", "de": "straße häuser über größe müßig bücher"}
    say = lambda lang, n: " ".join(rng.choice(own[lang].split()) for _ in range(n))
    rows = [(k, say(lang, 40), lang) for k, lang in enumerate(list(own) * 60)]
    mixed = " ".join(say(lang, 12) for lang in own)
    rows += [(None, mixed, None), (None, "12 34", None), (None, say("en", 30), None), (900, "", "en"), (900, say("de", 30), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.accepted(docs)
    assert got.schema == docs.schema
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in docs.collect() if r.text not in ("12 34", ""))


def test_predictions_are_those_of_all_labellings(spark, field):
    rng = random.Random(8)
    rows = [(k, " ".join(text(rng, rng.choice(list(SOUNDS)), 1) for _ in range(rng.randrange(1, 7)))) for k in range(40)]
    got = {r.doc_id: r for r in langid.predict_languages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), field).collect()}
    for k, t in rows:
        mean = brute(field, langid.words_of(t)).mean(axis=0)
        assert got[k].lang_pred == field.langs[int(mean.argmax())] and abs(got[k].score - mean.max()) < 1e-4


def test_accepted_are_those_of_all_labellings(spark):
    rng = random.Random(9)
    rows = [(k, text(rng, lang, 6), lang) for k, lang in enumerate(list(SOUNDS) * 20)]
    rows += [(100 + k, " ".join("".join(rng.choice("bcdfgxyzaeiou") for _ in range(5)) for _ in range(4)), None) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.train(docs)
    means = {k: brute(learned, langid.words_of(t)).max(axis=1).mean() for k, t, _ in rows}
    for least in (0.4, 0.9):
        got = {r.doc_id for r in langid.accepted(docs, least).collect()}
        assert {k for k, m in means.items() if m >= least + 1e-4} <= got <= {k for k, m in means.items() if m >= least - 1e-4}


@pytest.mark.parametrize("words", ["a" * 1_000_000, " " * 1_000_000, "1" * 1_000_000, "." * 1_000_000, "ba " * 300_000])
def test_long_texts(field, words):
    began = time.time()
    list(langid._Labeller(field).probabilities([langid.words_of(words)], False))
    assert time.time() - began < 15
