import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken

from quarrymill.llm import bpe


@pytest.fixture(scope="module")
def own():
    return bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def texts():
    rng = random.Random(5)
    yield from ["", " ", "a", "\n\n \t x", "don't we'll", "naïve café 日本語 😀😀", "<|endoftext|>", "x" * 700, "ab" * 900, "é" * 400]
    for alphabet in ("ab", "abcdefghijklmnop ", "etaoinshrdlu .,\n'", "0123456789- ", "éèçüß漢字😀\x00\x85 "):
        for size in (3, 17, 90, 600, 3000):
            yield "".join(rng.choice(alphabet) for _ in range(size))
    yield "".join(rng.choice("etaoinshrdlucmfw") for _ in range(20_000))


def test_ids_are_the_librarys(own, library):
    found = list(texts())
    for text, got in zip(found, own.encode(found, {})):
        assert got == packed(library.encode_ordinary(text)), text[:60]


def test_round_trip(own):
    for text, got in zip(list(texts()), own.encode(texts(), {})):
        assert own.decode(got) == text.encode()


def test_small_cache_gives_the_same(own, monkeypatch):
    whole = list(own.encode(texts(), {}))
    monkeypatch.setattr(bpe, "CHARS", 50)
    monkeypatch.setattr(bpe, "CACHED", 5)
    assert list(own.encode(texts(), {})) == whole


def test_documents(spark, own, library):
    rows = [(1, "A dog.", "x"), (2, None, "y"), (2, None, "y"), (None, "été", None), (4, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.encoding_digests(docs).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    full = {r.doc_id: r for r in bpe.encode_documents(docs).collect()}
    assert full[1].ids == library.encode_ordinary("A dog.") and bytes(full[1].decoded) == b"A dog."
    assert bpe.encoding_digests(docs.limit(0)).collect() == []


def test_every_token_is_its_own_encoding(own):
    """What joining cut pieces by their neighbours rests on."""
    tokens = [own.decode(k.to_bytes(4, "little")) for k in range(len(own.lengths)) if own.lengths[k]]
    assert own._encode_rows(tokens) == [k.to_bytes(4, "little") for k in range(len(own.lengths)) if own.lengths[k]]


def long_pieces():
    rng = random.Random(8)
    yield from ("a" * 5000, "abc" * 2000, "." * 5000, "é" * 3000, " " * 5000)
    for alphabet in ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "._-=+#*", "漢字仮名交", "etaoin"):
        for size in (257, 1000, 20_000):
            yield "".join(rng.choice(alphabet) for _ in range(size))


def test_long_pieces_are_the_librarys(own, library):
    found = list(long_pieces())
    for text, got in zip(found, own.encode(found, {})):
        assert got == packed(library.encode_ordinary(text)), text[:40]


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "1" * 1_000_000, "." * 1_000_000])
def test_a_million_characters_without_a_break(own, text):
    began = time.time()
    (got,) = own.encode([text], {})
    assert own.decode(got) == text.encode() and time.time() - began < 10
