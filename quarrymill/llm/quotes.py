"""Quotation linking: nested quotes are parsed, quoted passages are hashed and joined to the messages that first wrote
them, and conversations are ordered by replies, without the quotes."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import sliced, stage, unstage

_QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])")
#: Words that begin a line such as "On Monday A wrote:", and its verbs (fixed values).
STARTS = frozenset(("On", "Am", "Le", "El", "Il", "Em", "Op", "Den"))
VERBS = frozenset(("wrote", "schrieb", "écrit", "escribió", "scritto", "escreveu", "schreef", "skrev"))


def quote_level(line: str) -> tuple[int, str]:
    """How many quote marks begin a line, and what follows them."""
    m = _QUOTE.match(line)
    return (m[1].count(">"), line[m.end() :]) if m else (0, line)


def is_attribution(line: str) -> bool:
    """Whether a line names the writer of the quote below it; of any length."""
    body = line.strip()
    words = body[:-1].split() if body.endswith(":") else []
    return bool(words) and (words[-1] in VERBS or (words[0] in STARTS and not VERBS.isdisjoint(words)))


def passage_hash(text: str) -> bytes | None:
    """128 bits of the words of a text in lower case; nothing without words."""
    words = " ".join(text.lower().split())
    return hashlib.md5(words.encode("utf-8", "surrogatepass")).digest() if words else None


def paragraphs(lines: list[str]) -> list[list[str]]:
    """Runs of lines that aren't blank."""
    out: list[list[str]] = [[]]
    for line in lines:
        if line.strip():
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [p for p in out if p]


def parts(paragraph: list[str]) -> list[str]:
    """A paragraph, its sentences and its lines: what may be quoted or written by itself."""
    whole = "\n".join(paragraph)
    return list(dict.fromkeys((whole, *_SENTENCE.split(" ".join(paragraph)), *paragraph)))


def parse(text: str | None) -> tuple[str, list[bytes], list[tuple[int, list[bytes]]]]:
    """(own text, hashes of own passages, quoted passages as (level, hashes)).

    A quoted passage is a paragraph of one level. Its hashes, the longest part first, are of the whole quote that it is
    in, of itself, and of its lines and sentences; own passages are hashed likewise. A line such as "On Monday A wrote:"
    right before a quote goes with it.
    """
    runs: list[tuple[int, list[str]]] = []
    for line in (text or "").replace("\r\n", "\n").split("\n"):
        level, rest = quote_level(line)
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(rest)
    own, quoted = [], []
    for k, (level, lines) in enumerate(runs):
        if level:
            for paragraph in paragraphs(lines):
                texts = ["\n".join(lines), *sorted(parts(paragraph), key=len, reverse=True)]
                hashes = list(dict.fromkeys(h for t in texts if (h := passage_hash(t))))
                if (level, hashes) not in quoted[-1:]:
                    quoted.append((level, hashes))
            continue
        if k + 1 < len(runs):
            last = len(lines)
            while last and not lines[last - 1].strip():
                last -= 1
            if last and is_attribution(lines[last - 1]):
                lines = lines[: last - 1]
        own += lines
    texts = ["\n".join(own), *(t for p in paragraphs(own) for t in parts(p))]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip(), list(dict.fromkeys(h for t in texts if (h := passage_hash(t)))), quoted


def _parsed(found):
    passage = pa.struct([("level", pa.int32()), ("hashes", pa.list_(pa.binary()))])
    for batch in sliced(found, 4):
        got = [parse(t) for t in batch.column(4).to_pylist()]
        quoted = pa.array([[{"level": n, "hashes": h} for n, h in g[2]] for g in got], pa.list_(passage))
        columns = [*(batch.column(k) for k in range(4)), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.binary())), quoted]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "conv_id", "turn", "role", "text", "own", "quoted"])


def places(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn, depth, position) of the messages in threads, from (conv_id, turn, parent).

    A thread is a tree, and its reply order a walk through it: each message is entered, then its replies by turn, then
    it is left. The steps of all walks are a linked list in a table. Each round every step learns what lies between it
    and a step twice as far, so n steps take log n rounds, and no thread has to fit anywhere: messages entered from a
    step on give its position, and those entered less those left its depth.
    """
    nodes = replies.select("conv_id", "turn").union(replies.select("conv_id", F.col("parent").alias("turn"))).distinct()
    after = F.lead("turn").over(Window.partitionBy("conv_id", "parent").orderBy("turn"))
    of_parent = replies.select("conv_id", "turn", "parent", after.alias("after"))
    first = replies.groupBy("conv_id", F.col("parent").alias("turn")).agg(F.min("turn").alias("child"))
    step = lambda turn, leaves: F.struct(turn.alias("turn"), F.lit(leaves).alias("leaves"))
    known = nodes.join(first, ["conv_id", "turn"], "left").join(of_parent, ["conv_id", "turn"], "left")
    enter = F.when(F.col("child").isNotNull(), step(F.col("child"), False)).otherwise(step(F.col("turn"), True))
    leave = F.when(F.col("after").isNotNull(), step(F.col("after"), False)).when(F.col("parent").isNotNull(), step(F.col("parent"), True)).otherwise(step(F.col("turn"), True))
    both = known.select("conv_id", F.explode(F.array(F.struct(step(F.col("turn"), False).alias("at"), enter.alias("next")), F.struct(step(F.col("turn"), True).alias("at"), leave.alias("next")))).alias("s"))
    ended = F.col("at") == F.col("next")  # a root is left: the walk's end, which leads to itself and counts nothing
    now = stage(
        both.select("conv_id", "s.at", "s.next").select(
            "conv_id", "at", "next", F.when(ended, 0).otherwise((~F.col("at.leaves")).cast("int")).cast("long").alias("entered"),
            F.when(ended, 0).otherwise(F.when(F.col("at.leaves"), -1).otherwise(1)).cast("long").alias("open"),
        ),
        "walks",
    )
    while True:
        far = now.select("conv_id", F.col("at").alias("next"), F.col("next").alias("further"), F.col("entered").alias("more"), F.col("open").alias("higher"))
        moved = F.col("further") != F.col("next")
        new = stage(now.join(far, ["conv_id", "next"]).select("conv_id", "at", F.col("further").alias("next"), (F.col("entered") + F.col("more")).alias("entered"), (F.col("open") + F.col("higher")).alias("open"), moved.alias("moved")), "walks")
        unstage(now)
        now = new
        if now.where("moved").isEmpty():
            break
    entered = now.where("NOT at.leaves").select("conv_id", F.col("at.turn").alias("turn"), F.col("next.turn").alias("thread_turn"), "entered", "open")
    whole = entered.where("turn = thread_turn").select("conv_id", "thread_turn", F.col("entered").alias("size"))
    # From a step to the end all that is open is left: one more than what has been entered since, for each ancestor.
    return entered.join(whole, ["conv_id", "thread_turn"]).select("conv_id", "turn", "thread_turn", (1 - F.col("open")).alias("depth"), (F.col("size") - F.col("entered")).alias("position"))


def reply_order(messages: DataFrame) -> DataFrame:
    """(conv_id, thread_turn, position, depth, turn, role, parent_turn, n_quotes, n_linked, text) for each message.

    A quoted passage links to the first message of its conversation that wrote it, if that is earlier: by the longest of
    its parts that any earlier message wrote. The parent is the link of the lowest quote level, the latest of several.
    thread_turn is the turn where the chain of parents ends, a message's own turn without one; by (conv_id, thread_turn,
    position) a conversation is in reply order: each message, then its replies by turn, each followed by its own. depth
    is the number of messages above it. text has no quotes. A conversation stays a set of rows, so that none is too large
    for a task.

    A null text is empty. Messages with a null conversation or turn link with nothing; thread_turn is the turn, null
    where that is null, and position and depth are 0. Repeated rows are messages of their own and share a place; where
    rows of one turn have several parents, the chain goes on through the first. Texts of any length are parsed whole.
    Other columns are not read. An empty table gives an empty result.
    """
    types = {c: messages.schema[c].dataType.simpleString() for c in ("conv_id", "turn", "role")}
    kinds = f"conv_id {types['conv_id']}, turn {types['turn']}, role {types['role']}"
    picked = messages.select(F.monotonically_increasing_id().alias("row"), "conv_id", "turn", "role", "text")
    parsed = stage(picked.mapInArrow(_parsed, f"row long, {kinds}, text string, own array<binary>, quoted array<struct<level:int,hashes:array<binary>>>"), "messages")
    quotes = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("row", "conv_id", "turn", F.posexplode("quoted").alias("quote", "q"))
    wanted = stage(quotes.select("row", "conv_id", "turn", "quote", "q.level", F.posexplode("q.hashes").alias("part", "passage")), "quotes")
    none = F.lit(None).cast(types["turn"])
    if wanted.isEmpty():
        unstage(wanted)
        return parsed.select(
            "conv_id", F.col("turn").alias("thread_turn"), F.lit(0).cast("long").alias("position"), F.lit(0).cast("long").alias("depth"), "turn", "role", none.alias("parent_turn"),
            F.size("quoted").cast("long").alias("n_quotes"), F.lit(0).cast("long").alias("n_linked"), "text",
        )
    written = parsed.where("turn IS NOT NULL").select("conv_id", "turn", F.explode("own").alias("passage"))
    first = written.join(wanted.select("conv_id", "passage").distinct(), ["conv_id", "passage"], "left_semi").groupBy("conv_id", "passage").agg(F.min("turn").alias("origin"))
    found = wanted.join(first, ["conv_id", "passage"]).where("origin < turn")
    linked = found.groupBy("row", "conv_id", "turn", "quote").agg(F.min(F.struct("part", "level", "origin")).alias("link"))
    replies = stage(
        linked.groupBy("row", "conv_id", "turn").agg(F.min(F.struct("link.level", (-F.col("link.origin")).alias("late"), "link.origin")).alias("best"), F.count(F.lit(1)).alias("n_linked"))
        .select("row", "conv_id", "turn", F.col("best.origin").alias("parent"), "n_linked"),
        "replies",
    )
    unstage(wanted)
    placed = places(stage(replies.groupBy("conv_id", "turn").agg(F.min("parent").alias("parent")), "parents"))
    of_row = replies.select("row", F.col("parent").alias("parent_turn"), "n_linked")
    return (
        parsed.join(of_row, "row", "left").join(placed, ["conv_id", "turn"], "left")
        .select(
            "conv_id", F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("position", F.lit(0)).cast("long").alias("position"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "turn", "role",
            "parent_turn", F.size("quoted").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "text",
        )
    )
