"""Language identification by a linear-chain conditional random field over the words of a text.

Affixes, character n-grams and lexicons of the languages are the features of a word; transitions are learned, from
training sequences that switch between languages. Forward-backward gives each word its languages' probabilities, so
that code-switched texts are labelled word by word; a text's language is the one with the highest mean.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import held_out, sliced

#: The bound of training: about so many labelled rows for each language, whole texts.
ROWS = 250
#: Feature weights for each language.
BUCKETS = 1 << 17
LENGTH, BATCH, EPOCHS, RATE, DECAY = 48, 256, 6, 0.25, 1e-5
TOKENS, CACHED = 1 << 18, 300_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORD.findall((text or "").lower())


def features(word: str, lexicon: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Buckets of a word's features: itself, affixes, n-grams, and the lexicons that have it."""
    w = word.encode()
    if len(w) == len(word):  # characters are bytes
        starts, ends, edged = [w[:k] for k in range(1, 5)], [w[-k:] for k in range(1, 5)], b"^" + w + b"$"
        grams = [edged[k : k + 2] for k in range(len(w) + 1)] + [edged[k : k + 3] for k in range(len(w))]
    else:
        starts, ends, edged = [word[:k].encode() for k in range(1, 5)], [word[-k:].encode() for k in range(1, 5)], f"^{word}$"
        grams = [edged[k : k + n].encode() for n in (2, 3) for k in range(len(edged) - n + 1)]
    out = {crc32(b"w" + w), *map(crc32, grams), *[crc32(b"p" + x) for x in starts], *[crc32(b"s" + x) for x in ends]}
    out.update(crc32(b"lexicon%d" % k) for k in lexicon.get(word, ()))
    return np.fromiter(out, np.int64, len(out)) % BUCKETS


@dataclass
class Crf:
    """Languages, weights of features (BUCKETS by languages), start and transition scores, and lexicons."""

    langs: list[str]
    weights: np.ndarray
    start: np.ndarray
    moves: np.ndarray
    lexicon: dict[str, tuple[int, ...]]

    def emissions(self, words: list[str]) -> np.ndarray:
        rows = [features(w, self.lexicon) for w in words]
        sizes = np.array([len(r) for r in rows])
        sums = np.add.reduceat(self.weights[np.concatenate(rows)], np.cumsum(sizes) - sizes, axis=0)
        return (sums / np.sqrt(sizes)[:, None]).astype(np.float32)

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each place t from last to first: (t, probabilities of the texts that have a word there).

        ``scores`` has the words' scores by place, and within a place by text; ``lengths`` don't increase.
        """
        moves = np.exp(self.moves - self.moves.max()).astype(np.float32)
        start = np.exp(self.start - self.start.max()).astype(np.float32)
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than t
        ends = np.cumsum(alive)
        near = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
        ahead = np.empty_like(near)
        last = start[None, :]
        for t in range(len(alive)):
            here = slice(ends[t] - alive[t], ends[t])
            x = near[here] * (last[: alive[t]] @ moves if t else last)
            last = x / x.sum(axis=1, keepdims=True)
            ahead[here] = last
        behind = np.ones((0, len(self.langs)), np.float32)
        for t in range(len(alive) - 1, -1, -1):
            here = slice(ends[t] - alive[t], ends[t])
            full = np.ones((alive[t], len(self.langs)), np.float32)
            full[: len(behind)] = behind
            both = ahead[here] * full
            yield t, both / both.sum(axis=1, keepdims=True)
            x = (near[here] * full) @ moves.T
            behind = x / x.sum(axis=1, keepdims=True)


def learn(samples: list[tuple[str, list[str]]], seed: int = 7) -> Crf:
    """A field from (language, words of a passage). Passages are cut into stretches of a few to some dozens of words
    and shuffled, so that sequences switch between languages."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for lang, _ in samples})
    number = {lang: k for k, lang in enumerate(langs)}
    counts = [Counter() for _ in langs]
    for lang, words in samples:
        counts[number[lang]].update(set(words))
    lexicon = {}
    for word in set().union(*counts) if counts else ():
        if found := tuple(k for k, c in enumerate(counts) if c[word] >= 3):
            lexicon[word] = found
    size = len(langs)
    field = Crf(langs, np.zeros((BUCKETS, size)), np.zeros(size), np.zeros((size, size)), lexicon)
    pieces = []
    for lang, words in samples:
        at = 0
        while at < len(words):
            n = int(rng.integers(4, 60))
            pieces.append((number[lang], words[at : at + n]))
            at += n
    stream = [(lang, w) for k in rng.permutation(len(pieces)) for lang in pieces[k][:1] for w in pieces[k][1]]
    if not stream:
        return field
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for _, w in stream))}
    rows = [features(w, lexicon) for w in vocabulary]
    sizes = np.array([len(r) for r in rows])
    flat, first = np.concatenate(rows), np.cumsum(sizes) - sizes
    n = -(-len(stream) // LENGTH)
    pad = n * LENGTH - len(stream)
    word = np.array([vocabulary[w] for _, w in stream] + [0] * pad).reshape(n, LENGTH)
    label = np.array([lang for lang, _ in stream] + [0] * pad).reshape(n, LENGTH)
    full = np.arange(n * LENGTH).reshape(n, LENGTH) < len(stream)
    squares = [np.full(p.shape, 1e-6) for p in (field.weights, field.moves, field.start)]
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            pick = order[at : at + BATCH]
            used, where = np.unique(word[pick], return_inverse=True)
            where = where.reshape(len(pick), LENGTH)
            own = np.concatenate([flat[first[u] : first[u] + sizes[u]] for u in used])
            of = np.repeat(np.arange(len(used)), sizes[used])
            scale = 1 / np.sqrt(sizes[used])
            scores = np.add.reduceat(field.weights[own], np.cumsum(sizes[used]) - sizes[used], axis=0) * scale[:, None]
            emit, moves, start = _gradient(field, scores[where], label[pick], full[pick])
            per_word = np.stack([np.bincount(where.ravel(), emit[..., k].ravel(), len(used)) for k in range(size)], 1) * scale[:, None]
            touched, inverse = np.unique(own, return_inverse=True)
            grad = np.stack([np.bincount(inverse, per_word[of, k], len(touched)) for k in range(size)], 1) / len(pick)
            grad -= DECAY * field.weights[touched]
            squares[0][touched] += grad**2
            field.weights[touched] += RATE * grad / np.sqrt(squares[0][touched])
            for k, (parameter, g) in enumerate(((field.moves, moves), (field.start, start)), 1):
                squares[k] += (g / len(pick)) ** 2
                parameter += RATE * g / len(pick) / np.sqrt(squares[k])
    field.weights = field.weights.astype(np.float32)
    return field


def _gradient(field: Crf, scores: np.ndarray, label: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the log-likelihood of the labels: by word, by transition and by start."""
    n, length, size = scores.shape
    near = np.exp(scores - scores.max(axis=2, keepdims=True))
    near[~full] = 1
    moves = np.exp(field.moves)
    ahead, behind = np.empty_like(near), np.ones_like(near)
    x = near[:, 0] * np.exp(field.start)
    for t in range(length):
        if t:
            x = near[:, t] * (ahead[:, t - 1] @ moves)
        ahead[:, t] = x / x.sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        x = (near[:, t + 1] * behind[:, t + 1]) @ moves.T
        behind[:, t] = x / x.sum(axis=1, keepdims=True)
    both = ahead * behind
    both /= both.sum(axis=2, keepdims=True)
    emit = (np.eye(size)[label] - both) * full[..., None]
    pair = ahead[:, :-1, :, None] * moves * (near * behind)[:, 1:, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    on = full[:, 1:]
    want = np.bincount((label[:, :-1] * size + label[:, 1:])[on], minlength=size * size).reshape(size, size)
    first = np.bincount(label[full[:, 0], 0], minlength=size) - both[full[:, 0], 0].sum(axis=0)
    return emit, want - pair[on].sum(axis=0), first


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Crf:
    """A field from about ROWS labelled rows of each language that aren't held out, chosen by a hash of the id.

    Their whole texts are used; what comes to the driver is bounded by the number of rows. Rows with a null language, id
    or text are not learned from.
    """
    known = docs.where(docs[id_col].isNotNull() & docs[lang_col].isNotNull() & docs[text_col].isNotNull() & ~held_out(id_col))
    counts = known.groupBy(docs[lang_col].alias("lang")).count().collect()
    chance = F.coalesce(*(F.when(docs[lang_col] == r["lang"], F.lit(ROWS / r["count"])) for r in counts), F.lit(0.0))
    draw = F.pmod(F.xxhash64(docs[id_col].cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(draw < chance).select(docs[id_col].cast("string"), docs[lang_col], docs[text_col])

    def rows(found):
        for batch in sliced(found, 2):
            out = []
            for key, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                out.append((lang, key, words_of(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.list_(pa.string())))], names=["lang", "key", "words"]
            )

    if not counts:
        return learn([])
    sample = picked.mapInArrow(rows, "lang string, key string, words array<string>").collect()
    return learn([(r.lang, r.words) for r in sorted(sample, key=lambda r: (r.lang, r.key))])


class _Labeller:
    """Scores of words, kept for distinct words up to a bound, and forward-backward over many texts at once."""

    def __init__(self, field: Crf):
        self.field, self.index, self.scores = field, {}, np.zeros((0, len(field.langs)), np.float32)

    def probabilities(self, texts: list[list[str]], each: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, mean probabilities, or with ``each`` those of each word) for texts with words."""
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(-lengths, kind="stable")
        order = order[: int((lengths > 0).sum())]
        ends = np.searchsorted(np.cumsum(lengths[order]) // TOKENS, np.arange(1 + lengths.sum() // TOKENS), side="right")
        at = 0
        for end in np.unique(ends):  # texts of like length, TOKENS words or one text at a time
            yield from self._block([texts[k] for k in order[at:end]], order[at:end], each)
            at = end

    def _block(self, texts, numbers, each):
        if not texts:
            return
        if len(self.index) > CACHED:
            self.index, self.scores = {}, self.scores[:0]
        new = list(dict.fromkeys(w for t in texts for w in t if w not in self.index))
        if new:
            self.scores = np.concatenate((self.scores, *(self.field.emissions(new[k : k + 20_000]) for k in range(0, len(new), 20_000))))
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        lengths = np.array([len(t) for t in texts])
        words = np.fromiter((self.index[w] for t in texts for w in t), np.int64, int(lengths.sum()))
        place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        words = words[np.argsort(place, kind="stable")]
        size = len(self.field.langs)
        total = np.zeros((len(texts), size))
        kept = [np.zeros((n, size), np.float32) for n in lengths] if each else []
        for t, p in self.field.marginals(self.scores[words], lengths):
            total[: len(p)] += p
            for k in range(len(p) if each else 0):
                kept[k][t] = p[k]
        for k, number in enumerate(numbers):
            yield int(number), kept[k] if each else total[k] / lengths[k]


def predict_languages(docs: DataFrame, field: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for each row: the language with the highest mean probability over the words, and that
    mean. A text that is null or has no letter is ``und`` with score 0, as is any text when no language was learned.
    Null ids stay; repeated rows give a row each; other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # BUCKETS by languages, and a lexicon of the bounded sample

    def rows(found):
        labeller = _Labeller(shared.value)
        for batch in sliced(found, 1):
            texts = batch.column(1).to_pylist()
            words = [words_of(t) for t in texts]
            words = [w if any(map(str.isalpha, "".join(w))) else [] for w in words] if shared.value.langs else [[] for _ in words]
            langs, scores = ["und"] * len(words), [0.0] * len(words)
            for k, p in labeller.probabilities(words, False):
                best = int(p.argmax())
                langs[k], scores[k] = labeller.field.langs[best], min(1.0, float(p[best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    picked = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    return picked.mapInArrow(rows, f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, lang_pred string, score double")


def label_words(docs: DataFrame, field: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, words, langs): the words of each text, lower-cased, and the likeliest language of each."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def rows(found):
        labeller = _Labeller(shared.value)
        for batch in sliced(found, 1):
            texts = batch.column(1).to_pylist()
            words = [words_of(t) for t in texts]
            langs: list[list[str]] = [[] for _ in words]
            for k, p in labeller.probabilities(words, True):
                langs[k] = [labeller.field.langs[b] for b in p.argmax(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string())), pa.array(langs, pa.list_(pa.string()))], names=[id_col, "words", "langs"])

    picked = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    return picked.mapInArrow(rows, f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, words array<string>, langs array<string>")


def language_report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the rows that aren't held out, predicted for all."""
    return predict_languages(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, least: float = 0.4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without texts in no language and those whose words' likeliest languages have a mean probability under
    ``least``, whichever languages these are. Each row is decided on by itself; ids, null or repeated ones too, are not
    compared."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col))
    at = docs.columns.index(text_col)

    def rows(found):
        labeller = _Labeller(shared.value)
        for batch in sliced(found, at):
            words = [words_of(t) for t in batch.column(at).to_pylist()]
            words = [w if any(map(str.isalpha, "".join(w))) else [] for w in words] if shared.value.langs else [[] for _ in words]
            keep = [False] * len(words)
            for k, p in labeller.probabilities(words, True):
                keep[k] = float(p.max(axis=1).mean()) >= least
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
