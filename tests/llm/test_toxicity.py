import math
import random
import time
import zlib

import pytest

from quarrymill.llm import toxicity

BAD = ["idiot", "moron", "trash"]
CLEAN = "the and other morning idea radio patio stone river garden window thin tree house apple table".split()


def passage(rng, bad):
    words = [rng.choice(CLEAN) for _ in range(30)]
    if bad:
        words[rng.randrange(30)] = rng.choice(BAD)
    return " ".join(words)


@pytest.fixture(scope="module")
def spelling():
    rng = random.Random(1)
    return toxicity.Spelling(toxicity.trigrams([passage(rng, k % 5 == 0) for k in range(500)]))


@pytest.mark.parametrize("written, word", [("m0r0n", "moron"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("iiidiooot", "idiot"), ("tr@$h", "trash"), ("garden", "garden")])
def test_restored(spelling, written, word):
    assert spelling.restore(written) == [word]


def test_viterbi_finds_the_least_cost(spelling):
    """Against every combination of what the characters may stand for."""
    from itertools import product

    def cost(symbols):
        a = b = 0
        total = 0.0
        for k, s in enumerate(symbols):
            if s or b or k >= len(symbols) - 2:
                total += float(spelling.cost[a, b, s])
                a, b = b, s
        return total

    for text in ("1d10t", "aa-b", "0+0", "s.t o"):
        runs = [m[0] for m in toxicity._RUN.finditer(text)]
        best = min(
            (sum(price for _, price in way) + cost([s for symbols, _ in way for s in symbols] + [0, 0]), [s for symbols, _ in way for s in symbols])
            for way in product(*(spelling.options(r[0], len(r)) for r in runs))
        )
        assert spelling.restore(text) == "".join(toxicity.LETTERS[s - 1] if s else " " for s in best[1]).split()


def test_texts_are_restored(spelling):
    assert toxicity.restored_text("the m0r0n and i d i o t tree", spelling) == "the moron and idiot tree"
    assert toxicity.restored_text(None, spelling) == ""


def test_held_out_and_disguised(spark):
    rng = random.Random(2)
    rows = [(k, passage(rng, k % 4 == 0)) for k in range(600)]
    labels = [(k, int(k % 4 == 0), 1) for k in range(500)]
    for k, bad in ((1000, "m0r0n"), (1001, "i d i o t"), (1002, "MORON!!"), (1003, "tr4sh")):
        rows.append((k, passage(rng, False) + f" {bad} " + passage(rng, False)))
    rows += [(2000, None), (2001, ""), (None, passage(rng, False)), rows[4]]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, toxic string")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, None, 1)], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.toxicity_report(docs, marks).collect()}
    assert len(got) == len(rows) - 1
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k in got if k is not None)
    assert sum(got[k].predicted == (k % 4 == 0) for k in range(600)) >= 595
    assert all(got[k].predicted == 1 for k in (1000, 1001, 1002, 1003))
    assert all(got[k].predicted == 0 for k in (2000, 2001, None))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity_report(docs.limit(0), labels).collect() == []
    assert toxicity.toxicity_report(docs, labels.limit(0)).count() == 1


@pytest.mark.parametrize("written", ["trasH!", "tra5h", "iidiot", "mooron", "id iot", "mor on,", "i d i o t!", "tr as h.", "the id iot tree"])
def test_disguises_are_decoded(spelling, written):
    words = written.split()
    found = {f for w in words for f in toxicity.forms(w, spelling)} | {w for _, _, run in toxicity.runs(words) for w in toxicity.joined(run, spelling)}
    assert found & set(BAD)


@pytest.mark.parametrize("written", ["idio7", "shi+", "mooron", "garden!"])
def test_words_with_signs_anywhere_are_looked_at(written):
    assert toxicity.odd(written)


def test_runs_are_left_out_only_without_marks(spelling):
    scorer = toxicity.Scorer({f: 5.0 for w in BAD for f in toxicity.features(w)})
    every = toxicity.Reader(scorer, spelling)
    every.may_mark = every.run_may_mark = lambda run: True
    rng = random.Random(4)
    pieces = "id iot mor on tra sh the and tree thin i d o t 1d 10t m00 tr@ sh! it's iid ott mmo idiot! m0ron tra$h gar-den".split()
    for _ in range(300):
        text = " ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        assert toxicity.Reader(scorer, spelling).marks(text) == every.marks(text), text


def plain_fit(sample):
    """Weights by counting in loops: features of a share of the toxic texts that are so many times as common there."""
    bad = [set(f) - {0} for b, f in sample if b]
    good = [set(f) - {0} for b, f in sample if not b]
    out = {}
    for f in set().union(*bad):
        in_bad, in_good = sum(f in s for s in bad), sum(f in s for s in good)
        if in_bad >= max(3, toxicity.SHARE * len(bad)):
            ratio = math.log((in_bad + 0.5) / (len(bad) + 1)) - math.log((in_good + 0.5) / (len(good) + 1))
            if ratio >= math.log(toxicity.TIMES):
                out[f] = ratio
    return out


def plain_score(scorer, spelling, text):
    """Every word and run decoded, nothing kept or left out."""
    words = (text or "").split()
    marks = {scorer.marks(toxicity.forms(w, spelling)) for w in words}
    marks |= {scorer.marks([w]) for _, _, run in toxicity.runs(words) for w in toxicity.joined(run, spelling)}
    most = [max(scorer.weights[f] for f in m) for m in marks if m]
    x = (max(most, default=0.0), max(0.0, max(most, default=0.0) - 5), math.log1p(len(most)))
    return 1 / (1 + math.exp(-(scorer.bias + sum(a * b for a, b in zip(scorer.slopes, x)))))


def test_report_is_that_of_plain_loops(spark):
    rng = random.Random(11)
    disguised = ["idiot", "m0r0n", "t r a s h", "id iot", "mooron!", "tra$h", "iidiott", "mor on"]
    rows = []
    for k in range(300):
        words = passage(rng, False).split()
        if k % 3 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(disguised))
        rows.append((k, " ".join(words)))
    rows += [(1000, None), (1001, "9.9 :) ... in 2019 a b c")]
    labels = [(k, int(k % 3 == 0)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.score for r in toxicity.toxicity_report(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    spelling = toxicity.Spelling(toxicity.trigrams([t for _, t in rows]))
    learned = [(bool(k % 3 == 0), toxicity.described(t.split(), spelling, {})) for k, t in rows[:300] if zlib.crc32(str(k).encode()) % 4 != 2]
    scorer = toxicity.fit(learned, sum(b for b, _ in learned), sum(not b for b, _ in learned))
    assert {f: round(w, 9) for f, w in scorer.weights.items()} == {f: round(w, 9) for f, w in plain_fit([(b, f.tolist()) for b, f in learned]).items()}
    for k, t in rows:
        assert abs(got[k] - plain_score(scorer, spelling, t)) < 1e-6, t


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "1" * 300_000 + "a", "a" + "." * 1_000_000 + "b", "a1" * 100_000, "!" * 1_000_000, "i d " * 100_000])
def test_long_texts_take_no_longer_than_their_length(spelling, text):
    scorer = toxicity.Scorer({f: 5.0 for w in BAD for f in toxicity.features(w)})
    began = time.time()
    toxicity.Reader(scorer, spelling).marks(text)
    assert time.time() - began < 15
