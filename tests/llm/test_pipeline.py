import hashlib
import random
import re

import corpus_pipeline

VOWELS = {"en": "aeo", "de": "äöü", "fr": "éèê"}


def text(rng, lang, n):
    return " ".join("".join(rng.choice("bcdfghklmnprst") + rng.choice(VOWELS[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def test_stages_against_plain_versions(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, text(rng, lang, rng.choice((30, 80, 200))), lang, "s", 0) for k, lang in enumerate(list(VOWELS) * 40)]
    items = [(k, text(rng, "en", 12)) for k in range(5)]
    rows += [(200 + k, rows[k][1].replace(" ", "\n"), "en", "s", 0) for k in range(10)]
    rows += [(300 + k, rows[k + 20][1] + " mehr", "en", "s", 0) for k in range(10)]
    rows += [(400 + k, f"{text(rng, 'en', 100)} {items[k][1]} {text(rng, 'en', 50)}", "en", "s", 0) for k in range(5)]
    rows += [(500, None, "en", None, None), (501, "12 34", None, "s", 0), (502, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    kept = {r[0]: r[1] for r in rows}
    for (name, step), plain in zip(corpus_pipeline.STAGES[:-1], (speech, first_of_equal, first_of_near, untested)):
        docs = spark.createDataFrame(step(spark, docs, str(tmp_path)).collect(), docs.schema)
        kept = plain(kept, items)
        assert docs.columns == names and sorted(r.doc_id for r in docs.collect()) == sorted(kept), name
    assert len(kept) == 120
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == sorted(kept)
    assert all(got[k].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() and got[k].n_tokens == len(got[k].ids) for k, t in kept.items())


def speech(kept, items):
    return {k: t for k, t in kept.items() if t and re.search(r"[^\W\d]", t)}


def first_of_equal(kept, items):
    first = {}
    for k in sorted(kept):
        first.setdefault(" ".join(kept[k].split()), k)
    return {k: kept[k] for k in first.values()}


def first_of_near(kept, items):
    sets = {k: set(zip(*(t.lower().split()[i:] for i in range(5)))) for k, t in kept.items()}
    gone = {a for a in kept for b in kept if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    return {k: t for k, t in kept.items() if k not in gone}


def untested(kept, items):
    return {k: t for k, t in kept.items() if not any(q in t for _, q in items)}


def test_near_copies_of_five_words(spark):
    from quarrymill.llm import ngram_join

    rng = random.Random(3)
    base = [text(rng, "en", 60).split() for _ in range(6)]
    rows = []
    for k in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 1, 1, 2))):
            words[rng.randrange(60)] = "x"
        rows.append((k, " ".join(words)))
    got = ngram_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), n=5, tenths=8).collect()
    sets = {k: set(zip(*(t.split()[i:] for i in range(5)))) for k, t in rows}
    label = {k: k for k in sets}
    moved = True
    while moved:
        moved = False
        for a in sets:
            for b in sets:
                if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) and label[a] > label[b]:
                    label[a], moved = label[b], True
    assert {r.doc_id: r.component_id for r in got} == label


def test_rows_without_ids_repeated_ids_and_empty_tables(spark, tmp_path):
    rng = random.Random(4)
    texts = [text(rng, "en", 60) for _ in range(8)]
    item = text(rng, "en", 12)
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)] + [(100 + k, text(rng, lang, 60), lang, "s", 0) for k, lang in enumerate(list(VOWELS) * 20)]
    rows += [(None, text(rng, "en", 60), "en", "s", 0), (None, texts[1].replace(" ", "\t"), "en", "s", 0), (None, "12", None, None, None), (None, f"{text(rng, 'en', 40)} {item}", "en", "s", 0)]
    rows += [(2, text(rng, "en", 60), "en", "t", 1), (3, texts[0] + " mehr", "en", "t", 1), (4, texts[4], "en", "s", 0), (5, f"{text(rng, 'en', 40)} {item}", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Gone: the copy without an id, the text without letters, both rows with the item, the near copy under another id, the repeated row.
    kept = [rows[k] for k in range(len(rows)) if k not in (69, 70, 71, 73, 74, 75)]
    want = sorted((str(r[0]), hashlib.sha256(r[1].encode()).hexdigest()) for r in kept)
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in got) == want
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, str(tmp_path))
        assert docs.collect() == []
