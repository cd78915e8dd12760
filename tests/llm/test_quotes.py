import random
import re
import time

import pytest

from quarrymill.llm import quotes


def quoted(text, level=1):
    return "\n".join("> " * level + line for line in text.split("\n"))


def test_parse():
    own, mine, found = quotes.parse("On Monday, Ann wrote:\n> one\n> > two\n>> three\nreply\n\n> four\nmore")
    assert own == "reply\n\nmore"
    assert [n for n, _ in found] == [1, 2, 1]
    assert quotes.passage_hash("two three") in found[1][1] and quotes.passage_hash("three") in found[1][1]
    assert quotes.passage_hash("REPLY") in mine
    assert quotes.parse(None) == ("", [], []) and quotes.parse("> only")[0] == ""
    assert quotes.quote_level("  >> > a") == (3, "a") and quotes.quote_level("a > b") == (0, "a > b")


@pytest.mark.parametrize("line", ["On Mon, A <a@b.c> wrote:", "Am 3.5. schrieb Anna:", "Le 3 mai, A a écrit :", "Ann wrote:", "On " + "x " * 500 + "wrote:"])
def test_lines_that_name_a_writer_go(line):
    assert quotes.parse(f"before\n{line}\n> words\nafter")[0] == "before\nafter"


def plain_lines(text):
    """(level, line) by hand."""
    for line in (text or "").split("\n"):
        level, k = 0, 0
        while k < len(line) and line[k] in " \t>":
            level += line[k] == ">"
            k += 1
        yield (level, line[k:]) if level else (0, line)


def units(lines):
    """The texts that count as written or quoted: all lines, their paragraphs, lines and sentences, normalised."""
    norm = lambda s: " ".join(s.lower().split())
    out = [norm(" ".join(lines))]
    for block in re.split(r"\n[ \t]*\n", "\n".join(lines)):
        out += [norm(block), *map(norm, re.split(r"(?<=[.!?])\s+", block.replace("\n", " "))), *map(norm, block.split("\n"))]
    return [u for u in dict.fromkeys(out) if u]


def brute(rows):
    """One conversation at a time, every message against every earlier one, with a parser of its own."""
    read = []
    for conv, turn, role, text in rows:
        own, runs = [], []
        for level, line in plain_lines(text):
            if level:
                if not runs or runs[-1][0] != level or runs[-1][2]:
                    runs.append([level, [], False])
                runs[-1][1].append(line)
            else:
                own.append(line)
                for r in runs:
                    r[2] = True
        passages = []
        for level, lines, _ in runs:
            for block in re.split(r"(?:^|\n)[ \t]*(?:\n|$)", "\n".join(lines)):
                if block.strip():
                    passage = (level, tuple(dict.fromkeys(units(lines)[:1] + sorted(units(block.split("\n")), key=len, reverse=True))))
                    if passage not in passages[-1:]:
                        passages.append(passage)
        read.append((conv, turn, role, own, set(units(own)), passages))
    out, parents = [], {}
    for conv, turn, role, own, _, passages in read:
        links = []
        for level, texts in passages if conv is not None and turn is not None else ():
            for t in texts:
                origin = min((b for a, b, _, _, wrote, _ in read if a == conv and b is not None and t in wrote), default=None)
                if origin is not None and origin < turn:
                    links.append((level, -origin))
                    break
        parent = -min(links)[1] if links else None
        out.append((conv, turn, role, parent, len(passages), len(links), re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip()))
        if parent is not None:
            parents[conv, turn] = min(parent, parents.get((conv, turn), parent))
    order = {}

    def walk(conv, turn, root, depth, count):
        order[conv, turn] = (root, count[0], depth)
        count[0] += 1
        for child in sorted(t for (c, t), p in parents.items() if (c, p) == (conv, turn)):
            walk(conv, child, root, depth + 1, count)

    for conv, parent in {(c, p) for (c, _), p in parents.items()}:
        if (conv, parent) not in parents:
            walk(conv, parent, parent, 0, [0])
    return sorted(((c, *order.get((c, t), (t, 0, 0)), t, role, p, n, k, own) for c, t, role, p, n, k, own in out), key=str)


def test_same_as_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(12):
        texts = []
        for turn in range(rng.choice((1, 3, 12, 40))):
            pieces = []
            for _ in range(rng.choice((0, 1, 1, 2))):
                if texts:
                    what = rng.choice(texts)
                    what = rng.choice((what, what.upper(), what.split("\n")[-1], what.split(". ")[0]))
                    pieces.append(quoted(what, rng.choice((1, 1, 2))))
            own = rng.choice(("yes", f"text {conv} {turn}", f"para {turn}\n\nmore {turn % 3}", f"line {turn}\nsecond {turn}", f"First {turn}. Second {turn}! Third"))
            texts.append(own)
            pieces.insert(rng.randrange(len(pieces) + 1), own)
            rows.append((conv, turn, rng.choice(("user", "assistant")), "\n".join(pieces)))
    rows += [(None, 1, "user", "> yes\nx"), (3, None, "user", "> yes"), (4, 99, None, None), rows[5], (4, 100, "user", "> no such\nthing")]
    messages = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, root int")
    got = sorted(map(tuple, quotes.reply_order(messages).collect()), key=str)
    want = brute(rows)
    assert got == want
    assert sum(r[8] for r in want) > 50 and max(r[3] for r in want) > 2
    assert quotes.reply_order(messages.limit(0)).collect() == []
    assert quotes.reply_order(messages).columns[:4] == ["conv_id", "thread_turn", "position", "depth"]


def test_chain(spark):
    rows = [(1, k, "user", (f"> m{k - 1}\n" if k else "") + f"m{k}") for k in range(50)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.reply_order(messages).collect()
    assert {r.thread_turn for r in got} == {0} and all(r.text == f"m{r.turn}" for r in got)
    assert all(r.parent_turn == (r.turn - 1 if r.turn else None) and r.depth == r.position == r.turn for r in got)


def test_second_line_of_a_paragraph_links(spark):
    rows = [(1, 0, "a", "first line\nsecond line"), (1, 1, "b", "> second line\nanswer"), (1, 2, "c", "other")]
    got = {r.turn: r for r in quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].parent_turn == 0 and got[1].n_linked == 1 and (got[2].thread_turn, got[2].position) == (2, 0)


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "1" * 1_000_000, "." * 1_000_000, ">" * 1_000_000, "> " * 500_000, "\n" * 1_000_000, "> a\n" * 100_000, "wrote " * 200_000 + ":"])
def test_long_texts_take_no_longer_than_their_length(text):
    began = time.time()
    quotes.parse(text)
    assert time.time() - began < 5
