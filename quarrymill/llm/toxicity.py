"""Toxicity of texts as written to be read: a noisy-channel model restores disguised words, and restored text is scored.

A character trigram model counts the whole corpus. Words with leetspeak, separators or repeated letters, and runs of
short words that may be one word in pieces, become lattices of what they may stand for; Viterbi finds the likeliest
spelling under channel costs and the character model. Words and word beginnings that mark toxic texts in a bounded
labelled sample have weights; a logistic regression on a text's strongest weight and on how many words have one gives the
score.

The lattice's letters are those of Latin-1: words in other scripts are read as they are written. In scoring, what has no
spelling with a marked word is not decoded: the filter follows all spellings at once, so nothing is missed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import held_out, sliced

#: The bound of training: about so many labelled rows of either class, by a hash of the id.
TOXIC_ROWS, CLEAN_ROWS = 1500, 4500
#: A feature needs this share of the toxic sample, and to be so many times as common there as in the other.
SHARE, TIMES = 0.01, 40
THRESHOLD = 0.3
CACHED = 100_000
#: Words of up to so many characters may be pieces of one; longer runs of them are always decoded.
PIECE, RUN = 4, 64

#: Letters of the character model; all else is a word's edge (symbol 0). The table has (1 + letters) ** 3 counts.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
SIZE = 1 + len(LETTERS)
#: What signs stand for in disguised spelling (fixed values).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c"}
#: Channel costs in nats: a sign for a letter, a separator dropped, a sign of LEET dropped or taken as an edge, a letter
#: written twice, and three times or more.
SIGN, DROP, WASTE, TWICE, STRETCHED = 1.0, 0.5, 3.0, 2.0, 0.5

_SYMBOL = {c: k for k, c in enumerate(LETTERS, 1)}
_OF_BYTE = np.array([_SYMBOL.get(bytes([b]).decode("latin-1"), 0) for b in range(256)], np.int64)
_RUN = re.compile(r"(.)\1*", re.S)
_TWICE, _SIGN = re.compile(r"([^\W\d_])\1", re.I), re.compile(r"[0-9@$!|+€£(]")
_PARTED = re.compile(r"[^\W\d_][\W_]+[^\W\d_]")
_LETTER = re.compile(r"[^\W\d_]")
#: A feature: up to four symbols that it begins with, six bits each, and this many bits of a hash.
BEGIN, HASH_BITS = 4, 40


def trigrams(texts: Iterable[str | None]) -> np.ndarray:
    """Counts of three symbols in a row, each text between edges."""
    raw = " \0 ".join(t or "" for t in texts).lower().encode("latin-1", "replace")
    s = np.concatenate(([0, 0], _OF_BYTE[np.frombuffer(raw, np.uint8)], [0, 0]))
    return np.bincount((s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:], minlength=SIZE**3)


class Spelling:
    """Viterbi over a word's lattice under a character trigram model."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SIZE, SIZE, SIZE).astype(float)
        one = three.sum(axis=(0, 1)) + 1.0
        two = three.sum(axis=0)
        low = one / one.sum()
        middle = (two + 5 * low) / (two.sum(axis=1, keepdims=True) + 5)
        self.cost = -np.log((three + 5 * middle) / (three.sum(axis=2, keepdims=True) + 5)).astype(np.float32)

    def options(self, sign: str, n: int) -> list[tuple[tuple[int, ...], float]]:
        """What a run of n equal characters may stand for, with channel costs."""
        own = _SYMBOL.get(sign)
        if own:
            once, twice = (own,), (own, own)
            return [(once, 0.0)] if n == 1 else [(twice, 0.0), (once, TWICE)] if n == 2 else [(twice, STRETCHED), (once, STRETCHED)]
        letters = LEET.get(sign, "")
        out = [((0,), WASTE * bool(letters)), ((), (WASTE if letters else DROP) * n)]
        for letter in letters:
            out += [((_SYMBOL[letter],) * k, SIGN * k) for k in {1, min(n, 2)}]
        return out

    def restore(self, text: str) -> list[str]:
        """The words of the likeliest spelling. Every state, the last two symbols, keeps its best path."""
        paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for run in [*(m[0] for m in _RUN.finditer(text.lower())), None]:
            choices = [((0, 0), 0.0)] if run is None else self.options(run[0], len(run))
            new: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (cost, path) in paths.items():
                for symbols, price in choices:
                    total, x, y, way = cost + price, a, b, path
                    for s in symbols:
                        if s or y or run is None:  # edges in a row are one
                            total += float(self.cost[x, y, s])
                            x, y, way = y, s, (way, s)
                    if (x, y) not in new or total < new[x, y][0]:
                        new[x, y] = (total, way)
            paths = new
        way, out = min(paths.values(), key=lambda p: p[0])[1], []
        while way:
            way, s = way
            out.append(LETTERS[s - 1] if s else " ")
        return "".join(reversed(out)).split()


def odd(word: str) -> bool:
    """Whether a word has letters, and a sign that may stand for one, a separator or a letter twice in a row."""
    return bool((_SIGN.search(word) or _TWICE.search(word) or _PARTED.search(word)) and _LETTER.search(word))


def trimmed(word: str, before: str, after: str) -> str:
    """Without the characters at its ends that are neither letters or digits nor among ``before`` or ``after``."""
    start, end = 0, len(word)
    while start < end and not (word[start].isalnum() or word[start] in before):
        start += 1
    while end > start and not (word[end - 1].isalnum() or word[end - 1] in after):
        end -= 1
    return word[start:end]


def core(word: str) -> str:
    """A written word in lower case without signs at its edges."""
    return trimmed(word.lower(), "_@$", "")


def piece(word: str) -> str | None:
    """A word that may be a part of one, lower-cased and without punctuation before and after it; None if too long."""
    if len(word) > PIECE + 4:
        return None
    out = trimmed(word.lower(), "_@$!|+€£(", "_@$|+€£") or word
    return out if len(out) <= PIECE else None


def forms(word: str, spelling: Spelling) -> list[str]:
    """The core of a word, and its restored spelling where it looks disguised."""
    out = [c] if (c := core(word)) else []
    if odd(word):
        out += [w for w in spelling.restore(word) if w not in out]
    return out


def runs(words: list[str]) -> list[tuple[int, int, list[str]]]:
    """(start, end, pieces) of runs of two or more short words, which may be words in pieces, some with letters."""
    out, run = [], []
    for k, w in enumerate([*words, None]):
        part = None if w is None else piece(w)
        if part is not None:
            run.append(part)
            continue
        if len(run) > 1 and _LETTER.search("".join(run)):
            out.append((k - len(run), k, run))
        run = []
    return out


def joined(run: list[str], spelling: Spelling) -> list[str]:
    """The distinct words of a run's likeliest spelling that it doesn't have as they are."""
    own = set(run)
    return [w for w in dict.fromkeys(spelling.restore(" ".join(run))) if w not in own]


def restored_text(text: str | None, spelling: Spelling) -> str:
    """A text with its disguised words restored."""
    words, at, out = (text or "").split(), 0, []
    alone = lambda ws: [(forms(w, spelling) or [w])[-1] for w in ws]
    for start, end, run in runs(words):
        out += alone(words[at:start]) + (spelling.restore(" ".join(run)) if joined(run, spelling) else alone(words[start:end]))
        at = end
    return " ".join(out + alone(words[at:]))


def beginning(text: str) -> str:
    """The first characters of a text, BEGIN at most, in which repeated ones count once."""
    out = last = ""
    if len(text) >= BEGIN and len(set(text[:BEGIN])) == BEGIN:
        return text[:BEGIN]
    for c in text:
        if c != last:
            out += c
            if len(out) == BEGIN:
                break
            last = c
    return out


def feature(text: str, salt: str = "") -> int:
    """A hash that also has the beginning of the text; characters outside of LETTERS are all one symbol there."""
    code = 0
    for c in beginning(text):
        code = code << 6 | _SYMBOL.get(c, 63)
    return code << HASH_BITS | xxhash.xxh3_64_intdigest(salt + text) >> (64 - HASH_BITS)


def features(word: str) -> list[int]:
    """A word, and its beginnings."""
    return [feature(word, "="), *(feature(word[:k]) for k in range(3, min(len(word), 8) + 1))]


@dataclass
class Scorer:
    """Weights of features; the regression's bias and coefficients."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -2.0
    slopes: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def marks(self, words: list[str]) -> tuple[int, ...]:
        """The features with weights among those of a word's forms."""
        return tuple(f for w in words for f in features(w) if f in self.weights)

    def strength(self, words: Iterable[tuple[int, ...]]) -> tuple[float, float, float]:
        """Of the marks of distinct words: the largest weight, that beyond 5, and the logarithm of one and their number."""
        best = [max(self.weights[f] for f in marks) for marks in words]
        most = max(best, default=0.0)
        return most, max(0.0, most - 5), math.log1p(len(best))

    def score(self, words: Iterable[tuple[int, ...]]) -> float:
        z = self.bias + sum(a * b for a, b in zip(self.slopes, self.strength(words)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class Reader:
    """The marks of texts; what is known of distinct words and runs is kept up to a bound."""

    def __init__(self, scorer: Scorer, spelling: Spelling):
        self.scorer, self.spelling = scorer, spelling
        #: Of words: (marks, piece); of runs, and of two pieces in a row: marks, and whether they may begin a marked word.
        self.words: dict[str, tuple[tuple[int, ...], str | None]] = {}
        self.runs: dict[str, tuple[tuple[int, ...], ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.beginnings: dict[str, bool] = {}
        #: What words with marks begin with, repeated letters once, and the shorter beginnings of that.
        self.begin, self.shorter = set(), {""}
        for f in scorer.weights:
            symbols = [s for k in reversed(range(BEGIN)) if (s := f >> HASH_BITS + 6 * k & 63)]
            if symbols and 63 not in symbols:
                letters = "".join(LETTERS[s - 1] for s in symbols)
                self.begin.add(letters)
                self.shorter.update(letters[:k] for k in range(1, len(letters)))

    def marks(self, text: str | None) -> set[tuple[int, ...]]:
        """The marks of each distinct word that has any."""
        words = (text or "").split()
        if max(len(self.words), len(self.runs), len(self.pairs), len(self.beginnings)) > CACHED:
            self.words, self.runs, self.pairs, self.beginnings = {}, {}, {}, {}
        known = self.words
        for w in set(words).difference(known):
            low = w.lower()
            if low.isalpha():  # what core, odd and piece say of plain words
                body, strange, part = low, _TWICE.search(low), low if len(low) <= PIECE and len(w) <= PIECE + 4 else None
            else:
                body, strange, part = core(w), odd(w), piece(w)
            own = forms(w, self.spelling) if strange and self.may_mark(low) else [body]
            known[w] = self.scorer.marks([x for x in own if self.may_have(x)]), part
        found = [known[w] for w in words]
        out = {marks for marks, _ in found}
        run: list[str] = []
        for _, part in [*found, ((), None)]:
            if part is not None:
                run.append(part)
            elif run:
                if len(run) > 1 and self.run_may_mark(run):
                    key = " ".join(run)
                    if key not in self.runs:
                        self.runs[key] = tuple(self.scorer.marks([w]) for w in joined(run, self.spelling)) if _LETTER.search(key) else ()
                    out.update(self.runs[key])
                run = []
        out.discard(())
        return out

    def may_have(self, word: str) -> bool:
        """False only for words without marks: none of their features begins as one with a weight does."""
        b = beginning(word)
        may = self.beginnings.get(b)
        if may is None:
            may = any(b[:k] in self.begin for k in range(1, len(b) + 1)) or any(c not in _SYMBOL for c in b)
            self.beginnings[b] = may
        return may

    def may_mark(self, text: str) -> bool:
        """False only where no spelling of a text has a word with marks: none can begin as one. A word begins after
        anything but a letter; signs stand for letters or are dropped, and repeated letters count once."""
        begun: set[str] = set()
        edge = True
        for c in text:
            if edge:
                begun.add("")
            letter = c in _SYMBOL
            new = set() if letter else begun.copy()
            for other in c if letter else LEET.get(c, ""):
                for b in begun:
                    longer = b if b.endswith(other) else b + other
                    if longer in self.begin:
                        return True
                    if longer in self.shorter:
                        new.add(longer)
            begun, edge = new, not letter
        return False

    def run_may_mark(self, run: list[str]) -> bool:
        """The same of a run; one of plain letters only has other words where neighbours are joined."""
        for two in zip(run, run[1:]):
            may = self.pairs.get(two)
            if may is None:
                whole = "".join(two)
                if all(c in _SYMBOL for c in whole):
                    b = beginning(whole)
                    may = b in self.shorter or any(b[:k] in self.begin for k in range(1, len(b) + 1))
                else:
                    may = True
                self.pairs[two] = may
            if may:
                key = " ".join(run)
                return key in self.runs or self.may_mark(key)
        return False


def described(words: list[str], spelling: Spelling, known: dict[str, tuple[str, ...]]) -> np.ndarray:
    """The features of the distinct words of a text, with a 0 after each word's; ``known`` keeps the words' forms."""
    if len(known) > CACHED:
        known.clear()
    own = set()
    for w in set(words):
        if w not in known:
            known[w] = tuple(forms(w, spelling))
        own.add(known[w])
    own.update((w,) for _, _, run in runs(words) for w in joined(run, spelling))
    return np.fromiter((f for word in own for form in [*word, None] for f in ([0] if form is None else features(form))), np.uint64)


def count_trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The character model's counts over all texts; at most SIZE ** 3 numbers come to the driver."""

    def rows(found):
        total = np.zeros(SIZE**3, np.int64)
        for batch in sliced(found, 0):
            total += trigrams(batch.column(0).to_pylist())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    sums = docs.select(docs[text_col].alias("text")).mapInArrow(rows, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(SIZE**3, np.int64)
    for gram, n in sums.collect():
        out[gram] = n
    return out


def train(docs: DataFrame, labels: DataFrame, spelling: Spelling) -> Scorer:
    """A scorer from about TOXIC_ROWS and CLEAN_ROWS labelled rows that aren't held out, whole texts, in hashed form.

    Rows with null ids or labels are not learned from; of several labels of an id the highest counts.
    """
    known = labels.where(labels["doc_id"].isNotNull() & labels["toxic"].isNotNull() & ~held_out())
    known = known.groupBy(labels["doc_id"].alias("id")).agg((F.max("toxic") > 0).alias("bad"))
    counts = {r["bad"]: r["count"] for r in known.groupBy("bad").count().collect()}
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chance = F.when(F.col("bad"), TOXIC_ROWS / max(1, counts.get(True, 0))).otherwise(CLEAN_ROWS / max(1, counts.get(False, 0)))
    sample = known.where(draw < chance)
    shared = docs.sparkSession.sparkContext.broadcast(spelling)  # SIZE ** 3 costs

    def rows(found):
        known: dict[str, tuple[str, ...]] = {}
        for batch in sliced(found, 1):
            out = [described((text or "").split(), shared.value, known).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["bad", "features"])

    # The sample's size is bounded by its two parameters, so it can be sent to every task.
    picked = docs.join(F.broadcast(sample), docs["doc_id"] == sample["id"]).select("bad", docs["text"])
    got = [(r.bad, np.frombuffer(bytes(r.features), np.uint64)) for r in picked.mapInArrow(rows, "bad boolean, features binary").collect()]
    return fit(got, counts.get(True, 0), counts.get(False, 0))


def fit(sample: list[tuple[bool, np.ndarray]], toxic: int, clean: int) -> Scorer:
    """Weights, and the regression by Newton's method on the sample, which counts as ``toxic`` and ``clean`` rows."""
    n_bad = sum(bad for bad, _ in sample)
    n_good = len(sample) - n_bad
    if not n_bad or not n_good:
        return Scorer(bias=math.log((toxic + 0.5) / (clean + 0.5)))
    sets = [np.setdiff1d(f, np.zeros(1, np.uint64)) for _, f in sample]
    ids, in_bad = np.unique(np.concatenate([f for (bad, _), f in zip(sample, sets) if bad]), return_counts=True)
    enough = in_bad >= max(3, SHARE * n_bad)
    ids, in_bad = ids[enough], in_bad[enough]
    in_good = np.zeros(len(ids))
    for (bad, _), f in zip(sample, sets):
        if not bad:
            in_good += np.isin(ids, f, assume_unique=True)
    ratio = np.log((in_bad + 0.5) / (n_bad + 1)) - np.log((in_good + 0.5) / (n_good + 1))
    scorer = Scorer({int(i): float(r) for i, r in zip(ids, ratio) if r >= math.log(TIMES)})
    marked = np.fromiter(scorer.weights, np.uint64)
    points = []
    for bad, f in sample:
        of_word = np.cumsum(f == 0)
        groups: dict[int, list[int]] = {}
        for k in np.flatnonzero(np.isin(f, marked)).tolist():
            groups.setdefault(int(of_word[k]), []).append(int(f[k]))
        points.append((1.0, *scorer.strength({tuple(g) for g in groups.values()})))
    x, y = np.array(points), np.array([bad for bad, _ in sample], float)
    mass = np.where(y > 0, toxic / n_bad, clean / n_good)
    mass *= len(y) / mass.sum()
    beta, ridge = np.zeros(4), np.diag([1e-3, 0.1, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (mass * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (mass * (y - p)) - ridge @ beta)
        beta += step
    scorer.bias, scorer.slopes = float(beta[0]), tuple(beta[1:].tolist())
    return scorer


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; predicted is 1 from a score of THRESHOLD.

    Null and empty texts get the score of a text without marks. Null ids are not held out. Repeated rows give a row
    each; other columns are not read. Without labels the score is one constant. An empty table gives an empty result.
    Texts of any length are read whole.
    """
    spelling = Spelling(count_trigrams(docs))
    model = docs.sparkSession.sparkContext.broadcast((train(docs, labels, spelling), spelling))  # bounded by the sample
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(found):
        scorer, spelled = model.value
        reader = Reader(scorer, spelled)
        for batch in sliced(found, 1):
            scores = [scorer.score(reader.marks(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
