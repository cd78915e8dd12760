import hashlib
import random
import re
import time

import pytest

from quarrymill.llm import pii


def plain(text):
    """The four expressions as they are written, without any short cut."""
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], ["email", "ip", "card", "phone"].index(s[0])))


def test_base_spans_are_those_of_the_expressions():
    rng = random.Random(1)
    pieces = ["a.b@c.de", "@", "x@y", "x@y.z@w.v", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+", "+12", "é", " ", "-", ".", "0", "12345", "\n", "%", "a"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert pii.base_spans(text) == plain(text), text
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 50_000, "+1" + " " * 100_000, "@" * 50_000):
        pii.base_spans(text)  # in linear time


def rows():
    out = [(k, f"Call me: phone +1 (0{k:02d}) 555-7{k:03d} today") for k in range(40)]
    out += [(100 + k, f"Call me: phone 0{k} 555 7{k:03d} today") for k in range(3)]
    out += [(200 + k, f"the number {k}555{k:04d}1 is any") for k in range(20)]
    out += [(300 + k, f"mail to é {k}@mail.example.com, or {k}.1.2.3") for k in range(10)]
    return out + [(400, None), (401, ""), (None, "a@b.cc"), (0, rows_first())]


def rows_first():
    return "Call me: phone +1 (000) 555-7000 today"


def test_bootstrap_adds_identifiers_in_known_contexts(spark):
    data = rows()
    docs = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, kind string").repartition(3)
    got = sorted(pii.personal_data_report(docs).collect(), key=lambda r: str(r.doc_id))
    assert len(got) == len(data)
    texts = dict(data)
    for r in got:
        base = plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        if r.doc_id in (100, 101, 102):
            start = texts[r.doc_id].index("phone") + 6
            assert r.spans == f"phone:{start}:{texts[r.doc_id].index(' today')}"
        else:
            assert r.spans == joined


def test_empty_table(spark):
    assert pii.personal_data_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_identifiers_beside_found_ones():
    text = "reach john@x.com 555-123-4567 or 555-123-4568 a@y.org 555-123-4569"
    got = [(text[s:e], kind, forms) for s, e, _, kind, _, forms in pii.mentions(text, pii.base_spans(text))]
    assert [v for v, kind, _ in got if kind] == ["john@x.com", "a@y.org"]
    assert [(v, forms) for v, kind, forms in got if not kind] == [(f"555-123-456{k}", ["phone"]) for k in (7, 8, 9)]


def test_bootstrap_finds_identifiers_beside_found_ones(spark):
    data = [(k, f"reach me{k}@x.com +1 (0{k:02d}) 555-7{k:03d} today") for k in range(40)]
    data += [(100 + k, f"reach me{k}@x.com 0{k} 555 7{k:03d} today") for k in range(3)]
    got = {r.doc_id: r.spans for r in pii.personal_data_report(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    for k, text in data[40:]:
        assert got[k].endswith(f",phone:{text.index(' 0') + 1}:{text.index(' today')}")


def looped(edges, rounds):
    """The scoring by plain loops over a list of (pattern, value, kind, seed)."""
    scores = {(v, k): float(s) for _, v, k, s in edges}
    for _, v, k, s in edges:
        scores[v, k] = max(scores[v, k], float(s))
    own, confident = dict(scores), {}
    for _ in range(rounds):
        confident = {}
        for p, k in {(p, k) for p, _, k, _ in edges}:
            mine = [(v, s) for q, v, x, s in edges if (q, x) == (p, k)]
            share = sum(scores[v, k] for v, _ in mine) / len({v for q, v, _, _ in edges if q == p})
            if sum(s for _, s in mine) >= pii.SEEDS and share >= pii.CONFIDENT:
                confident[p, k] = share
        for v, k in own:
            wrong = 1.0
            for p in {p for p, w, x, _ in edges if (w, x) == (v, k)}:
                wrong *= max(1 - confident[p, k], 1e-6) if (p, k) in confident else 1.0
            scores[v, k] = max(own[v, k], 1 - wrong)
    return confident, scores


def test_graph_is_scored_as_by_loops(spark):
    rng = random.Random(6)
    edges = set()
    for v in range(60):
        seed = rng.random() < 0.7
        for p in rng.sample(range(12), 3):
            for kind in ("phone", "card")[: rng.choice((1, 2))]:
                edges.add((f"p{p}", f"v{v}", kind, seed and kind == "phone"))
    edges = sorted(edges)
    patterns, values = pii.scored_values(spark.createDataFrame(edges, "pattern string, value string, kind string, seed boolean"))
    want_patterns, want_values = looped(edges, pii.ROUNDS)
    got = {(r.pattern, r.kind): round(r.confidence, 6) for r in patterns.collect()}
    assert got == {k: round(v, 6) for k, v in want_patterns.items()} and got
    assert {(r.value, r.kind): round(r.score, 6) for r in values.collect()} == {k: round(v, 6) for k, v in want_values.items()}


def test_shapes_of_seeds_find_identifiers_without_contexts(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    data = [(k, f"{word()} {word()} +1 (0{k:02d}) 555-7{k:03d} {word()}") for k in range(40)]
    # What follows makes one run of too many digits of both, so that no expression finds the phone.
    data += [(100 + k, f"{word()} {word()} +1 (0{k:02d}) 555-8{k:03d} 10.1.2.{k} {word()}") for k in range(3)]
    got = {r.doc_id: r for r in pii.personal_data_report(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    for k, text in data[40:]:
        assert got[k].n_phone == 0 and got[k].spans.startswith(f"phone:{text.index('+')}:{text.index(' 10.')},ip:")


@pytest.mark.parametrize("text", ["a" * 1_000_000 + "1", "1" * 1_000_000, "." * 1_000_000 + "@1", " " * 1_000_000 + "1", "a1 " * 300_000, "a@b.c " * 100_000, "1.1.1.1 " * 100_000, "+1 " * 200_000])
def test_long_texts_take_no_longer_than_their_length(text):
    began = time.time()
    pii.mentions(text, pii.base_spans(text))
    assert time.time() - began < 8
