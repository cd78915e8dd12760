"""Byte-level BPE on length-bucketed padded matrices, and back.

Texts are cut by the tokenizer's pattern; each distinct piece is encoded once per sub-batch and kept in a bounded
cache. Pieces of like length are the rows of one matrix of token ids. In each round every row merges its leftmost
pair of minimum rank, found by a hashed lookup of pairs; rows without a pair left are taken out.

A sequence of tokens is the encoding of its bytes exactly if each two neighbours are the encoding of theirs. So a piece of
any length is cut into rows of ROW bytes, and what stands around a cut is encoded again, further out each time, until all
neighbours fit.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from quarrymill.llm.common import sliced

NONE = np.int32(2**31 - 1)
#: Bytes of a row that a long piece is cut into.
ROW = 256
#: Cells of a matrix, characters of a sub-batch, and pieces that a worker keeps.
CELLS, CHARS, CACHED = 1 << 18, 1 << 19, 200_000


class PairTable:
    """Rank of each mergeable pair of ids in an open-addressing table that is probed for whole arrays at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(4 * len(rank)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = self._key(left, right)
        rest, slot = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            free = np.flatnonzero(self.keys[slot[rest]] == -1)
            places, first = np.unique(slot[rest[free]], return_index=True)
            won = rest[free[first]]
            self.keys[places], self.ranks[places] = keys[won], rank[won]
            rest = np.setdiff1d(rest, won, assume_unique=True)
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where there is none or an id is negative."""
        keys = self._key(left, np.where(right < 0, 0, right)).ravel()
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.ranks[slot], NONE)
        rest = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
            got = self.keys[slot[rest]]
            hit = got == keys[rest]
            out[rest[hit]] = self.ranks[slot[rest[hit]]]
            rest = rest[~hit & (got != -1)]
        return np.where((left < 0).ravel() | (right < 0).ravel(), NONE, out).reshape(left.shape)


class ByteBpe:
    """The vocabulary of a rank file: ``encode_pieces``, ``encode`` and ``decode``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        found = [
            (ranks[t[:k]], ranks[t[k:]], rank)
            for t, rank in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        self.pairs = PairTable(*np.array(found, np.int32).reshape(-1, 3).T)

    @classmethod
    def load(cls, raw: bytes, pattern: str) -> ByteBpe:
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}, pattern)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """For each piece its ids, packed as little-endian unsigned 32-bit integers."""
        cut = [[p[k : k + ROW] for k in range(0, len(p), ROW)] for p in pieces]
        rows = iter(self._encode_rows([r for c in cut for r in c]))
        out: list[bytes] = []
        for c in cut:
            parts = [next(rows) for _ in c]
            out.append(parts[0] if len(parts) == 1 else self._joined(parts))
        return out

    def _joined(self, parts: list[bytes]) -> bytes:
        """The encoding of a piece from those of its rows. ``doubt``: places whose neighbours may not fit, and how many
        tokens on either side are encoded again if they don't."""
        ids = np.concatenate([np.frombuffer(p, "<u4") for p in parts])
        cuts = np.cumsum([len(p) // 4 for p in parts])[:-1]
        doubt = {int(c): 1 for c in cuts}
        while doubt:
            places = sorted(doubt)
            pairs = [self.decode(ids[k - 1 : k + 1].tobytes()) for k in places]
            wrong = [k for k, got in zip(places, self._encode_rows(pairs)) if got != ids[k - 1 : k + 1].tobytes()]
            spans: list[list[int]] = []  # [start, end, reach] of tokens to encode again, those that meet as one
            for k in wrong:
                start, end, reach = max(0, k - 2 * doubt[k]), min(len(ids), k + 2 * doubt[k]), 2 * doubt[k]
                if spans and start <= spans[-1][1]:
                    spans[-1] = [spans[-1][0], max(end, spans[-1][1]), max(reach, spans[-1][2])]
                else:
                    spans.append([start, end, reach])
            doubt, kept, at = {}, [], 0
            fresh = self._encode_rows([self.decode(ids[s:e].tobytes()) for s, e, _ in spans])
            size = 0
            for (start, end, reach), new in zip(spans, fresh):
                kept += [ids[at:start], np.frombuffer(new, "<u4")]
                size += start - at
                doubt[size] = doubt[size + len(new) // 4] = reach
                size += len(new) // 4
                at = end
            kept.append(ids[at:])
            ids = np.concatenate(kept)
            doubt = {k: r for k, r in doubt.items() if 0 < k < len(ids)}
        return ids.tobytes()

    def _encode_rows(self, pieces: list[bytes]) -> list[bytes]:
        """The encodings of pieces on matrices of rows of like length."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        out: list[bytes] = [b""] * len(pieces)
        order = np.argsort(lengths, kind="stable")
        at = int(np.searchsorted(lengths[order], 1))
        while at < len(order):
            width = int(1 << int(lengths[order[at]] - 1).bit_length())  # bucket: up to the next power of two
            end = min(int(np.searchsorted(lengths[order], width, side="right")), at + max(1, CELLS // width))
            rows = order[at:end]
            flat = np.frombuffer(b"".join(pieces[r].ljust(width, b"\0") for r in rows), np.uint8)
            ids = self.of_byte[flat].reshape(len(rows), width)
            ids[np.arange(width)[None, :] >= lengths[rows][:, None]] = -1
            for r, row in zip(rows, self._merge_rows(ids)):
                out[r] = row
            at = end
        return out

    def _merge_rows(self, ids: np.ndarray) -> list[bytes]:
        """Merges all rows of a padded matrix to their end."""
        done: list[bytes] = [b""] * len(ids)
        where = np.arange(len(ids))
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.full((len(ids), 1), NONE)
        while len(ids):
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(ids)), best]
            over = rank == NONE
            if over.any():
                sizes = (ids[over] >= 0).sum(axis=1) * 4
                for w, row, n in zip(where[over], ids[over].astype("<u4"), sizes):
                    done[w] = row.tobytes()[:n]
                keep = ~over
                ids, ranks, where, best, rank = ids[keep], ranks[keep], where[keep], best[keep], rank[keep]
                if not len(ids):
                    break
                used = int((ids >= 0).sum(axis=1).max())
                ids, ranks = ids[:, :used], ranks[:, : used - 1]
            rows, width = np.arange(len(ids)), ids.shape[1]
            column = np.arange(width - 1)[None, :]
            moved = column + (column > best[:, None])
            merged = np.full((len(ids), width), -1, np.int32)
            merged[:, :-1] = np.take_along_axis(ids, moved, axis=1)
            merged[rows, best] = rank
            ids = merged
            after = np.full((len(ids), width - 1), NONE, np.int32)
            after[:, :-1] = np.take_along_axis(ranks, np.minimum(moved[:, :-1], width - 2), axis=1)
            ranks = after
            right = np.where(best + 1 < width, ids[rows, np.minimum(best + 1, width - 1)], -1)
            last = best < width - 1
            ranks[rows[last], best[last]] = self.pairs.find(rank[last], right[last])
            left = best > 0
            ranks[rows[left], best[left] - 1] = self.pairs.find(ids[rows[left], best[left] - 1], rank[left])
        return done

    def encode(self, texts: Iterable[str], cache: dict[str, bytes]) -> Iterator[bytes]:
        """The packed ids of each text; ``cache`` has the packed ids of pieces and is emptied beyond CACHED."""
        find = regex.compile(self.pattern).findall
        block: list[list[str]] = []
        size = 0
        for text in [*texts, None]:
            if text is not None:
                block.append(find(text))
                size += len(text)
            if block and (text is None or size >= CHARS):
                if len(cache) > CACHED:
                    cache.clear()
                new = list({p for pieces in block for p in pieces if p not in cache})
                cache.update(zip(new, self.encode_pieces([p.encode() for p in new])))
                for pieces in block:
                    yield b"".join(map(cache.__getitem__, pieces))
                block, size = [], 0

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids."""
        ids = np.frombuffer(packed, "<u4")
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        return self.blob[np.arange(total) + np.repeat(self.starts[ids] - ends + sizes, sizes)].tobytes()


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> ByteBpe:
    with open(path, "rb") as f:
        return ByteBpe.load(f.read(), pattern)


def encode_documents(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>, decoded binary) for each row; null text counts as empty, and an empty text has no ids.

    ``path`` names a rank file and ``pattern`` its splitting pattern; by default byte_bpe_50k. Repeated rows and
    null ids give a row each. Other columns of ``docs`` are not read. Texts and pieces of any length are encoded whole.
    An empty table gives an empty result.
    """
    return _run(docs, path, pattern, id_col, text_col, "ids array<int>, decoded binary", _full)


def encoding_digests(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): what :func:`encode_documents` gives, as digests."""
    return _run(docs, path, pattern, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)


def encoded_with_digests(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, ids): :func:`encoding_digests` with the ids."""
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"
    return _run(docs, path, pattern, id_col, text_col, columns, lambda p, d: [*_digest(p, d), _ids(p)])


def _ids(packed: list[bytes]) -> pa.Array:
    """Packed ids as lists, without an object for each."""
    values = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(p) // 4 for p in packed)]), pa.int32()), pa.array(values))


def _full(packed: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
    return [_ids(packed), pa.array(decoded, pa.binary())]


def _digest(packed: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
    digests = (pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()) for texts in (packed, decoded))
    return [pa.array([len(p) // 4 for p in packed], pa.int64()), *digests]


def _run(docs, path, pattern, id_col, text_col, columns, made) -> DataFrame:
    # The vocabulary is a fixed file of under 1 MB, whatever the input: its size bounds what is sent to each worker.
    shared = docs.sparkSession.sparkContext.broadcast(
        vocabulary(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    )
    picked = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    names = [id_col, *(c.split()[0] for c in columns.split(", "))]

    def rows(found):
        bpe, cache = shared.value, {}
        for batch in sliced(found, 1, CHARS):
            packed = list(bpe.encode((t or "" for t in batch.column(1).to_pylist()), cache))
            yield pa.RecordBatch.from_arrays([batch.column(0), *made(packed, [bpe.decode(p) for p in packed])], names=names)

    schema = f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, {columns}"
    return picked.mapInArrow(rows, schema)
