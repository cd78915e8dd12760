"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash containment search.

Containment of an item in a whole document says little about their Jaccard similarity when the document is long. So
items are partitioned by size, and for each size class documents are cut into overlapping blocks of about that size:
an item lies whole in some block, where containment t of an item of q shingles means a Jaccard similarity of at least
t * q / (block + (1 - t) * q), 0.18 or more at t = 0.8. A block whose MinHash agrees with an item's in one of the
permutations is a candidate: at 0.18, 48 permutations miss one in 14,000, and a full copy (0.22 and more) one in 150,000.
Candidates are verified by the exact containment of the item's shingles in the whole document.

A MinHash agrees only in a shingle that both have. So blocks without any shingle of an item, and classes whose items
need more such shingles than a document has, are passed over; this loses nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from quarrymill.llm.common import ngram_hashes, sliced, stage, unstage, word_hashes

PERMUTATIONS = 48
#: Items in one pass, and characters of their texts: the bound of what is sent to each worker. More take more passes.
ITEMS, CHARS = 20_000, 1 << 24
#: Hashes that are permuted at once.
SLICE = 1 << 14
#: Bits of the place of a hash in the bitmap of all items' shingles.
PLACE_BITS = 23
#: Odd multipliers: each gives an order of 64-bit hashes.
_ODD = np.random.default_rng(20240607).integers(1 << 62, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = re.compile(r"[^\W_]+")


def normal_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits: case and punctuation don't hide a copy."""
    joined = "\n".join(_WORD.findall((text or "").lower())).encode("utf-8", "surrogatepass")
    return joined.split(b"\n") if joined else []


def exact_shingles(words: list[bytes], n: int) -> set[bytes]:
    """The distinct n-word shingles, or all words as one where they are fewer."""
    n = min(n, len(words))
    return {b" ".join(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def signature(hashes: np.ndarray) -> np.ndarray:
    return (hashes[None, :] * _ODD[:, None]).min(axis=1)


class Items:
    """Signatures of the items of one pass by size class, and their shingles."""

    def __init__(self, items: list[tuple[int, str]], n: int, least: float):
        self.shingles, words = {}, {}
        for item, text in items:
            words[item] = normal_words(text)
            self.shingles[item] = exact_shingles(words[item], n)
        #: Items under n words have a shingle of their own length: class key (words of a shingle, block's least size).
        groups: dict[tuple[int, int], list[int]] = defaultdict(list)
        for item, s in self.shingles.items():
            if s:
                length = min(n, len(words[item]))
                groups[length, 1 << (len(words[item]) - length).bit_length()].append(item)
        #: By length of a shingle: a bitmap of the items' shingles, and the classes (size, shingles that a document needs
        #: at least, sorted MinHash values, and whose they are).
        self.lengths: dict[int, tuple[np.ndarray, list]] = {}
        for (length, size), members in sorted(groups.items()):
            hashes = [ngram_hashes(word_hashes(words[m]), length) for m in members]
            values = np.concatenate([signature(h) for h in hashes])
            order = np.argsort(values, kind="stable")
            bitmap, classes = self.lengths.setdefault(length, (np.zeros(1 << PLACE_BITS, bool), []))
            bitmap[np.concatenate(hashes) >> np.uint64(64 - PLACE_BITS)] = True
            needed = min(np.ceil(least * len(self.shingles[m]) - 1e-9) for m in members)
            classes.append((size, needed, values[order], np.repeat(np.array(members, np.int64), PERMUTATIONS)[order]))

    def candidates(self, words: np.ndarray) -> set[int]:
        """Items whose MinHash agrees with that of a block somewhere."""
        found: set[int] = set()
        for length, (bitmap, classes) in self.lengths.items():
            if len(words) < length:
                continue
            hashes = ngram_hashes(words, length)
            hits = np.flatnonzero(bitmap[hashes >> np.uint64(64 - PLACE_BITS)])
            for size, needed, values, owner in classes:
                if len(hits) >= max(1, needed):
                    for minima in block_minima(hashes, hits, size):
                        low, high = np.searchsorted(values, minima), np.searchsorted(values, minima, side="right")
                        for a, b in zip(low[low < high].tolist(), high[low < high].tolist()):
                            found.update(owner[a:b].tolist())
        return found


def block_minima(hashes: np.ndarray, hits: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The MinHash values of the blocks, two stretches of ``size`` in a row each, that have a hit; some blocks at a time."""
    stretches = -(-len(hashes) // size)
    of_hit = np.unique(hits // size)
    blocks = np.unique(np.concatenate((of_hit - 1, of_hit)).clip(0, max(0, stretches - 2)))
    at_once = max(1, SLICE // size)
    for k in range(0, len(blocks), at_once):
        some = blocks[k : k + at_once]
        parts = np.unique(np.concatenate((some, np.minimum(some + 1, stretches - 1))))
        minima = np.empty((len(parts), PERMUTATIONS), np.uint64)
        for j in range(0, len(parts), at_once):
            for first in range(0, size, SLICE):  # a stretch may be longer than a slice
                places = (parts[j : j + at_once, None] * size + np.arange(first, min(size, first + SLICE))[None, :]).clip(max=len(hashes) - 1)
                low = np.stack([(hashes[places] * odd).min(axis=1) for odd in _ODD], axis=1)
                minima[j : j + at_once] = low if not first else np.minimum(minima[j : j + at_once], low)
        yield np.unique(np.minimum(minima[np.searchsorted(parts, some)], minima[np.searchsorted(parts, np.minimum(some + 1, stretches - 1))]))


def passes(items: DataFrame, item_col: str, item_text: str) -> Iterator[list[tuple]]:
    """The items, as many at a time as one pass takes."""
    block, size = [], 0
    for item, text in items.select(items[item_col], items[item_text]).where(items[item_text].isNotNull()).toLocalIterator():
        if block and (len(block) >= ITEMS or size + len(text) > CHARS):
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    if block:
        yield block


class Search:
    """The items of a pass that documents hold."""

    def __init__(self, block: list[tuple], n: int, least: float):
        self.block, self.least = block, least
        self.items = Items([(k, text) for k, (_, text) in enumerate(block)], n, least)

    def held(self, text: str | None) -> Iterator[tuple]:
        """(item, shingles of the item, those of them in the text)."""
        words = normal_words(text)
        have: dict[int, set[bytes]] = {}
        for k in sorted(self.items.candidates(word_hashes(words))) if words else ():
            want = self.items.shingles[k]
            length = next(iter(want)).count(b" ") + 1
            if length not in have:
                have[length] = exact_shingles(words, length)
            shared = len(want & have[length])
            if shared >= self.least * len(want):
                yield self.block[k][0], len(want), shared


def contamination(
    docs: DataFrame, items: DataFrame, n: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(id, item_id, n_shingles, n_shared, containment): each document that has ``least`` of an item's n-word shingles.

    Words are lower-cased runs of letters and digits. An item with fewer than n words is one shingle; an item or a
    document without words (null and empty ones too) matches nothing. Null ids are kept as they are. Rows that repeat
    an id and its text give the same pairs each. Other columns are not read. Empty tables give an empty result. A text
    of any length is searched whole, some blocks at a time.

    Items are taken in passes of ITEMS items and CHARS characters at most; a pass sends its items to the workers and
    reads the documents once, and one pass ends before the next. Documents are not shuffled.
    """
    spark = docs.sparkSession
    kind, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType
    schema = f"`{id_col}` {kind}, `{item_col}` {item_type.simpleString()}, n_shingles long, n_shared long, containment double"
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def searched(shared):
        def rows(found):
            search = Search(shared.value, n, least)
            for batch in sliced(found, 1):
                at, out = [], []
                for k, text in enumerate(batch.column(1).to_pylist()):
                    for got in search.held(text):
                        at.append(k)
                        out.append(got)
                kinds = (to_arrow_type(item_type), pa.int64(), pa.int64(), pa.float64())
                columns = [pa.array([(*o, o[2] / o[1])[k] for o in out], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=[id_col, item_col, "n_shingles", "n_shared", "containment"])

        return rows

    out, last = spark.createDataFrame([], schema), None
    for block in passes(items, item_col, item_text):
        if last is not None:
            out = out.unionByName(stage(picked.mapInArrow(searched(last), schema), "contamination"))
            last.destroy()
        last = spark.sparkContext.broadcast(block)
    return out if last is None else out.unionByName(picked.mapInArrow(searched(last), schema))


def clean_documents(
    docs: DataFrame, items: DataFrame, n: int = 5, least: float = 0.8, text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` without the rows that hold a test item, each judged by its own text; all columns stay. Ids, null or
    repeated ones too, are not compared, and rows aren't shuffled. An empty table on either side takes nothing away."""
    at = docs.columns.index(text_col)

    def kept(shared):
        def rows(found):
            search = Search(shared.value, n, least)
            for batch in sliced(found, at):
                yield batch.filter(pa.array([next(search.held(t), None) is None for t in batch.column(at).to_pylist()], pa.bool_()))

        return rows

    out, last, before = docs, None, None
    for block in passes(items, item_col, item_text):
        if last is not None:
            out = stage(out.mapInArrow(kept(last), docs.schema), "clean")
            last.destroy()
            unstage(before)
            before = out
        last = docs.sparkSession.sparkContext.broadcast(block)
    return out if last is None else out.mapInArrow(kept(last), docs.schema)


ORACLE_SQL = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark
), wanted AS (
  SELECT item_id, n, unnest(list_distinct(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' ')))) AS s
  FROM (SELECT item_id, w, least(5, len(w)) AS n FROM items WHERE len(w) > 0)
), held AS (
  SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS s
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), (SELECT DISTINCT n FROM wanted)
), sizes AS (
  SELECT item_id, count(*) AS n_shingles FROM wanted GROUP BY item_id
), shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM held JOIN wanted USING (n, s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_shingles
"""
