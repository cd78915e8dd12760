"""Personal data: fixed expressions, and identifiers that they miss but whose contexts give them away.

What the expressions find seeds a bootstrap. Every mention of something with a digit or an at sign has lexical patterns:
the words before it, the word after it, and its own shape. Patterns and mentioned values form a graph. Spark scores it in rounds: a
pattern by the share of its values that are known to be of a kind, a value by the patterns it occurs in. Values in
patterns of high confidence whose form fits the kind are new identifiers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import sliced, stage

KINDS = ("email", "ip", "card", "phone")
#: Rounds; seeds that a pattern needs; confidence that a pattern, and a value, needs.
ROUNDS, SEEDS, CONFIDENT = 3, 5, 0.8

_DIGIT = re.compile(r"[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK, _SPACE = re.compile(r"[0-9@]"), re.compile(r"\s")
_WORD = _LETTERS = re.compile(r"[^\W\d_]+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    """From each at sign the local part is read backwards and the domain forwards, so that long runs cost no more."""
    out, at, done = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            out.append((start, domain.end()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Numbers joined by dots, by fours from the left."""
    out = []
    for chain in _CHAIN.finditer(text):
        at, parts = chain.start(), chain[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[k : k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[k : k + 4]):
                out.append((at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = ((m, re.sub("[ -]", "", m[0])) for m in _CARD.finditer(text))
    return [m.span() for m, d in found if 12 <= len(d) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what the fixed expressions find, by start and then kind; a null text has none."""
    text, out = text or "", []
    if "@" in text:
        out += [("email", *s) for s in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *s) for s in ips(text)] + [("card", *s) for s in cards(text)]
        if "+" in text:
            out += [("phone", *s) for s in phones(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def fits(kind: str, value: str) -> bool:
    """Whether a value has the form of a kind, loosely."""
    digits = len(_DIGIT.findall(value))
    if kind == "email":
        return "@" in value and digits < len(value)
    if kind == "ip":
        return value.count(".") + value.count(":") >= 3 and digits >= 4
    if "@" in value or 3 * digits < 2 * len(value.replace(" ", "")):
        return False
    return 7 <= digits <= 15 if kind == "phone" else 12 <= digits <= 19 and luhn("".join(_DIGIT.findall(value)))


def shape(value: str) -> str:
    """A value with each digit as 9 and each run of letters as x."""
    return _LETTERS.sub("x", _DIGIT.sub("9", value))


def marked_stretches(text: str) -> Iterator[tuple[int, int]]:
    """Where tokens with a digit or an at sign stand, those with single spaces between them as one. Each character is
    looked at twice at most."""
    start = end = -1
    mark = _MARK.search(text)
    while mark:
        left = mark.start()
        while left > max(end, 0) and not text[left - 1].isspace():
            left -= 1
        space = _SPACE.search(text, mark.end())
        right = space.start() if space else len(text)
        if end < 0 or left != end + 1 or text[end] != " ":
            if end >= 0:
                yield start, end
            start = left
        end = right
        mark = _MARK.search(text, end)
    if end >= 0:
        yield start, end


def mentions(text: str | None, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str, str | None, list[str], list[str]]]:
    """(start, end, value, kind if the expressions found it, patterns, kinds whose form it has). What the expressions
    found is cut out of the mentions; the pieces beside it are mentions of their own."""
    text, out, at = text or "", [], 0
    if not ("@" in text or _DIGIT.search(text)):
        return out
    found = [(s, e, k) for k, s, e in base]
    free = []
    for start, end in marked_stretches(text):
        while at < len(found) and found[at][1] <= start:
            at += 1
        inside, k = [], at
        while k < len(found) and found[k][0] < end:
            if found[k][1] > start:
                inside.append(found[k])
            k += 1
        cut = start
        for s, e in [*((b[0], b[1]) for b in inside), (end, end)]:
            left, right, cut = cut, min(s, end), max(cut, e)
            while right > left and not text[right - 1].isalnum():
                right -= 1
            while left < right and not (text[left].isalnum() or text[left] in "+("):
                left += 1
            if right > left:
                free.append((left, right, None))
    for start, end, kind in [*found, *free]:
        value = text[start:end].lower()
        forms = [kind] if kind else [k for k in KINDS if fits(k, value)]
        if not forms:
            continue
        left = _WORD.findall(text[max(0, start - 80) : start].lower())[-2:]
        right = _WORD.findall(text[end : end + 40].lower())[:1]
        patterns = [f"{left[-1]} _"] if left else []
        patterns += [f"{' '.join(left)} _"] if len(left) == 2 else []
        patterns += [f"{left[-1]} _ {right[0]}"] if left and right else []
        patterns.append(f"_ {shape(value)}")
        out.append((start, end, re.sub(r"\W", "", value), kind, patterns, forms))
    return out


_MENTIONS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("kind", pa.string()), ("patterns", pa.list_(pa.string())), ("forms", pa.list_(pa.string()))]))
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(found):
    for batch in sliced(found, 2):
        texts = batch.column(2).to_pylist()
        base = [base_spans(t) for t in texts]
        spans = [[dict(zip(("kind", "start", "end"), s)) for s in b] for b in base]
        seen = [[dict(zip(("start", "end", "value", "kind", "patterns", "forms"), m)) for m in mentions(t, b)] for t, b in zip(texts, base)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _SPANS), pa.array(seen, _MENTIONS)], names=["row", "id", "base", "mentions"])


def scored_values(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, confidence) of the patterns that are confident in the end, and (value, kind, score) of values.

    ``edges``: distinct (pattern, value, kind, seed); kind is one of the value's possible kinds, and seed tells whether
    the expressions found the value as that kind. A pattern's confidence in a kind is the sum of its values' scores
    over the number of its values; it needs SEEDS seeds. A value's score is 1 if it is a seed, and else the chance that
    not all of its confident patterns are wrong.
    """
    size = edges.groupBy("pattern").agg(F.countDistinct("value").alias("values"))
    scores = edges.groupBy("value", "kind").agg(F.max(F.col("seed").cast("double")).alias("score"))
    patterns = None
    for _ in range(rounds):
        known = edges.join(scores, ["value", "kind"]).groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.sum(F.col("seed").cast("long")).alias("seeds"))
        confident = known.where(F.col("seeds") >= SEEDS).join(size, "pattern").withColumn("confidence", F.col("sum") / F.col("values"))
        patterns = stage(confident.where(F.col("confidence") >= CONFIDENT).select("pattern", "kind", "confidence"), "patterns")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        gained = edges.join(patterns, ["pattern", "kind"]).groupBy("value", "kind").agg((1 - doubt).alias("gained"))
        seeds = edges.groupBy("value", "kind").agg(F.max(F.col("seed").cast("double")).alias("own"))
        scores = stage(seeds.join(gained, ["value", "kind"], "left").select("value", "kind", F.greatest("own", F.coalesce("gained", F.lit(0.0))).alias("score")), "values")
    return patterns, scores


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) for each row: arrays of (kind, start, end) in code points, end exclusive; base has what the
    expressions find, spans also what the bootstrap adds, by start and then kind.

    Null and empty texts have no spans. Null ids stay; repeated rows give a row each, and count once as evidence, since
    values and patterns are distinct. Other columns are not read. An empty table gives an empty result. Texts of any
    length are read whole, in time that grows with their length.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    found = "array<struct<start:bigint,end:bigint,value:string,kind:string,patterns:array<string>,forms:array<string>>>"
    scanned = stage(picked.mapInArrow(_scan, f"row long, id {kind}, base {spans}, mentions {found}"), "mentions")
    seen = scanned.where("size(mentions) > 0").select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    of_pattern = seen.select("row", "start", "end", "value", "kind", "forms", F.explode("patterns").alias("pattern"))
    placed = of_pattern.select("row", "start", "end", "value", F.col("kind").alias("found"), "pattern", F.explode("forms").alias("kind"))
    seed = F.max(F.col("found").eqNullSafe(F.col("kind"))).alias("seed")
    edges = stage(placed.groupBy("pattern", "value", "kind").agg(seed), "edges")
    patterns, values = scored_values(edges)
    new = placed.where("found IS NULL")
    added = (
        new.join(patterns, ["pattern", "kind"], "left_semi").join(values.where(F.col("score") >= CONFIDENT), ["value", "kind"])
        .groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
        .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    order = F.array(*map(F.lit, KINDS))
    ranked = F.transform(F.concat("base", F.coalesce("added", F.array().cast(spans))), lambda s: F.struct(s.start.alias("start"), F.array_position(order, s.kind).alias("rank"), s.kind.alias("kind"), s.end.alias("end")))
    back = F.transform(F.sort_array(ranked), lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    return scanned.join(added, "row", "left").select(F.col("id").alias(id_col), "base", back.alias("spans"))


def joined(column: str):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def personal_data_report(docs: DataFrame) -> DataFrame:
    """The columns of the query: counts by kind of the base spans, their digest, and all spans."""
    found = personal_data(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
