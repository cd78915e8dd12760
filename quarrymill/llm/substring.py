"""Substring deduplication: words covered by a 50-word window that also starts in a document with a smaller id go.

Windows get Rabin-Karp hashes, which Spark counts; repeated windows merge into maximal intervals. Two facts keep the
count small without losing a window:

* Rows of one word sequence share every window, so the smallest id stands for them and the others are removed whole.
* Equal windows have equal least 8-grams (by hash). A window whose least 8-gram, its anchor, occurs in one document
  alone, copies aside, can't be repeated. Anchors are about one word in twenty; windows with repeated anchors are counted.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import mixed, ngram_hashes, sliced, stage, unstage, word_hashes, words_of

ANCHOR = 8
#: Odd multipliers of the two rolling hashes, modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def least(x: np.ndarray, n: int) -> np.ndarray:
    """The minimum of each run of ``n`` values, by doubling."""
    out, have = x, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Rabin-Karp hashes of all windows of a sequence at once: differences of prefix sums, shifted by inverse powers."""

    def __init__(self, window: int):
        self.window, self.powers = window, [(powers(b, 0), powers(pow(b, -1, 1 << 64), 0)) for b in BASES]

    def hashes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers[0][0]) < len(words):
            n = 2 * len(words)
            self.powers = [(powers(b, n), powers(pow(b, -1, 1 << 64), n)) for b in BASES]
        out = []
        for lane, (up, down) in zip((words, mixed(words ^ np.uint64(BASES[0]))), self.powers):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(lane * up[: len(lane)], dtype=np.uint64)))
            found = sums[self.window :] - sums[: len(sums) - self.window]
            out.append(found * down[: len(found)])
        return out[0], out[1]


def anchors(words: np.ndarray, window: int) -> np.ndarray:
    """For each window the hash of its least n-gram."""
    n = min(ANCHOR, window)
    return least(ngram_hashes(words, n), window - n + 1)


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """The maximal intervals [start, end) of words that windows at ``starts`` cover."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + window).tolist()))


def _profile(window: int):
    """One row per document that has a window: a hash of its word sequence and its distinct anchors."""

    def rows(found):
        for batch in sliced(found, 2):
            out = []
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                if len(words) >= window:
                    sequence = xxhash.xxh3_128_intdigest(b" ".join(words)).to_bytes(16, "little")
                    out.append((doc_id, key, sequence, np.unique(anchors(word_hashes(words), window)).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate((batch.schema[0].type, pa.int64(), pa.binary(), pa.list_(pa.int64())))],
                names=["id", "row_key", "sequence", "anchors"],
            )

    return rows


DONE, WAITING, WINDOWS = 0, 1, 2


def _spread(window: int, digest: bool):
    """Documents that need no count (DONE), texts of the others (WAITING), and their windows with repeated anchors."""

    def rows(found):
        roll = Rolling(window)
        for batch in sliced(found, 2):
            ids, keys, texts, copies, nths, lists = (c.to_pylist() for c in batch.columns)
            whole, parts = [], []
            for doc_id, key, text, copy, nth, repeated in zip(ids, keys, texts, copies, nths, lists):
                words = words_of(text)
                if copy or not repeated:
                    cover = [(0, len(words))] if copy else []
                    whole.append((DONE, doc_id, key, *_kept(words, cover, digest), None))
                    continue
                whole.append((WAITING, doc_id, key, None, None, None, None, text))
                x = word_hashes(words)
                at = np.flatnonzero(np.isin(anchors(x, window), np.array(repeated, np.int64).view(np.uint64)))
                one, two = roll.hashes(x)
                parts.append((doc_id, nth, at, one[at].view(np.int64), two[at].view(np.int64)))
            n, sizes = len(whole), [len(p[2]) for p in parts]
            total, kind = sum(sizes), batch.schema[0].type
            joined = lambda k, t: np.concatenate([p[k] for p in parts]).astype(t) if parts else np.zeros(0, t)
            of = np.repeat(np.arange(len(parts)), sizes)
            pad = lambda t: pa.nulls(total, t)
            first = [pa.array([w[k] for w in whole], t) for k, t in enumerate((pa.int32(), kind, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))]
            second = [
                pa.array(np.full(total, WINDOWS, np.int32)), pa.array([p[0] for p in parts], kind).take(pa.array(of)), pad(pa.int64()), pad(pa.int64()), pad(pa.int64()), pad(pa.string()), pad(pa.string()), pad(pa.string()),
                pa.array([p[1] for p in parts], pa.int32()).take(pa.array(of)), pa.array(joined(2, np.int32)), pa.array(joined(3, np.int64)), pa.array(joined(4, np.int64)),
            ]
            first += [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64())]
            for columns in (first, second):
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "id", "row_key", "n_words", "n_removed", "kept", "spans", "text", "nth", "at", "one", "two"])

    return rows


def _kept(words: list[bytes], cover: list[tuple[int, int]], digest: bool) -> tuple:
    """(n_words, n_removed, the kept words or their SHA-256, the removed intervals)."""
    kept, at = [], 0
    for start, end in cover:
        kept += words[at:start]
        at = end
    kept += words[at:]
    text = b" ".join(kept)
    return len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest() if digest else text.decode(), json.dumps(cover)


def _finish(window: int, digest: bool):
    def rows(found):
        for batch in sliced(found, 1):
            ids, texts, starts = (c.to_pylist() for c in batch.columns)
            out = [_kept(words_of(t), intervals(np.array(s or [], np.int64), window), digest) for t, s in zip(texts, starts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string())))],
                names=["id", "n_words", "n_removed", "kept", "spans"],
            )

    return rows


def remove_repeats(docs: DataFrame, window: int = 50, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept, spans) for each row: the words that stay, joined by one space (``digest``: the
    SHA-256 of that in hex), and the removed intervals of words as JSON ``[[start, end), ...]``.

    Null and empty texts have no words. A null id is smaller than none and no id is smaller than it: nothing is
    removed there or because of it. Rows with equal ids are one document; each is cleaned on its own. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).withColumn("row_key", F.xxhash64("id", "text"))
    profile = stage(
        rows.where("id IS NOT NULL").select("id", "row_key", "text").mapInArrow(_profile(window), f"id {kind}, row_key long, sequence binary, anchors array<long>"),
        "anchors",
    )
    # Tables that are joined with what they were counted from are written: the join then deals both sides itself, and
    # can split the rows of a hot group of copies, anchors or windows.
    leads = stage(profile.groupBy("sequence").agg(F.min("id").alias("lead")), "leads")
    of_leads = profile.join(leads, ["sequence"]).where("id = lead").select("id", "row_key", F.explode("anchors").alias("anchor"))
    repeated = stage(of_leads.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("anchor"), "repeated-anchors")
    lists = of_leads.join(repeated, "anchor").groupBy("id", "row_key").agg(F.collect_set("anchor").alias("repeated"))
    nth = F.dense_rank().over(_by_id()) - 1
    info = stage(
        profile.select("id", "row_key", "sequence").distinct().withColumn("nth", nth)
        .join(leads, "sequence").join(lists, ["id", "row_key"], "left")
        .select("id", "row_key", "nth", (F.col("lead") < F.col("id")).alias("copy"), "repeated")
        .where("copy OR repeated IS NOT NULL")
        .select("id", "row_key", "nth", "copy", F.when(~F.col("copy"), F.col("repeated")).alias("repeated")),
        "documents",
    )
    unstage(profile, leads, repeated)
    joined = rows.join(info, ["id", "row_key"], "left").select("id", "row_key", "text", "copy", "nth", "repeated")
    parts = stage(
        joined.mapInArrow(
            _spread(window, digest),
            f"kind int, id {kind}, row_key long, n_words long, n_removed long, kept string, spans string, text string, nth int, at int, one long, two long",
        ),
        "windows",
        by="kind",
    )
    windows = parts.where(F.col("kind") == WINDOWS).select("id", "nth", "at", "one", "two")
    both = windows.groupBy("one", "two").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    first = stage(both.where("first < last").drop("last"), "repeated")
    starts = (
        windows.join(first, ["one", "two"]).where("first < id").groupBy("id", "nth").agg(F.collect_list("at").alias("starts"))
    )
    waiting = parts.where(F.col("kind") == WAITING).select("id", "row_key", "text")
    keyed = starts.join(info.where("NOT copy").select("id", "nth", "row_key"), ["id", "nth"]).select("id", "row_key", "starts")
    finished = waiting.join(keyed, ["id", "row_key"], "left").select("id", "text", "starts").mapInArrow(
        _finish(window, digest), f"id {kind}, n_words long, n_removed long, kept string, spans string"
    )
    done = parts.where(F.col("kind") == DONE).select("id", "n_words", "n_removed", "kept", "spans")
    return done.unionByName(finished).withColumnRenamed("id", id_col)


def _by_id():
    from pyspark.sql import Window

    return Window.partitionBy("id").orderBy("row_key")


def removal_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of the query: (doc_id, n_words, n_removed, kept_sha256, spans)."""
    return remove_repeats(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, k, md5(array_to_string(w[k + 1:k + 50], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS k FROM words WHERE len(w) >= 50)
), firsts AS (
  SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), starts AS (
  SELECT doc_id, k, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) <= 50 THEN 0 ELSE 1 END AS fresh FROM windows JOIN firsts USING (h) WHERE first < doc_id
), islands AS (
  SELECT doc_id, min(k) AS a, max(k) + 50 AS b FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k) AS island FROM starts) GROUP BY doc_id, island
), gone AS (
  SELECT doc_id, list({'a': a, 'b': b} ORDER BY a) AS cover, sum(b - a)::BIGINT AS n_removed, '[' || string_agg('[' || a || ', ' || b || ']', ', ' ORDER BY a) || ']' AS spans FROM islands GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(spans, '[]') AS spans,
  sha256(array_to_string(CASE WHEN cover IS NULL THEN w ELSE list_filter(w, lambda x, i: len(list_filter(cover, lambda c: i > c.a AND i <= c.b)) = 0) END, ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""
