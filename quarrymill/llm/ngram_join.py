"""N-gram Jaccard self-join by vertical partitioning, as connected components of near copies.

The global order of shingles is cut into fragments. The rare end of the order gives candidates: documents that link must
share a shingle in their prefixes there (prefix filter). Candidates' overlaps are counted in each fragment by itself and
summed per pair; the sum decides.

* The order: shingles by the frequency of their cell, coarsely, then by hash. Cells are hashed; all occurrences in all
  documents are counted in them, so passages that very many documents share are at the frequent end, beyond nearly all
  prefixes. Any order is exact, this one keeps buckets small, and a document's prefix is known as soon as it is read.
* Documents of one set are one class and are joined once.
* Prefixes are longer than the least by a share of the set, so partners have several shingles in common there, and each
  set leaves as many of its most frequent ones out. What chance alone makes two documents share hardly stays.
* A bucket has the documents with one of these shingles. A group of m near copies has m * m / 2 links; only what they
  connect is asked for. So buckets are joined with their centre (the document with the fewest unshared shingles)
  first, documents that are connected already are left, and the pairs of a bucket that are still in different
  components come last, dealt by size as well. Size, position and parity bitmaps bound overlaps before anything is
  counted. None of these bounds loses a link.
* Sets are made for the documents of likely pairs alone: a filter of fixed size picks their texts from one more scan.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from quarrymill.llm.common import filter_place, in_filter, key_filter, mixed, ngram_hashes, sliced, stage, unstage, word_hashes, words_of
from quarrymill.llm.components import connected_components

FRAGMENTS = 4
#: Bits of a set's parity bitmap: a power of two, this many at least and no fewer than the set has shingles.
BITS = 512
#: Partners share a shingle in their prefixes, and one more for each so many shingles of the smaller set.
SHARE = 40
#: Rows of a bucket beyond which sizes deal them as well; pairs are the same.
MANY = 64
#: Cells in which occurrences are counted, and classes of their frequency: the k-th begins at 2 ** (k + 1) times the mean.
CELL_BITS, CLASS_BITS = 16, 3
ORDER_BITS = 60
#: Where the order is cut: the rare class into equal parts, the others as the last one.
CUTS = np.array([(k << ORDER_BITS) // (FRAGMENTS - 1) for k in range(1, FRAGMENTS)], np.uint64)


def shingle_hashes(text: str | None, n: int) -> np.ndarray:
    """64-bit hashes of a text's n-word shingles as they come, A-Z lower-cased."""
    return ngram_hashes(word_hashes(words_of(text, lower=True)), n)


def ordered_set(text: str | None, n: int, classes: np.ndarray) -> np.ndarray:
    """The distinct shingles of a text by the global order: a class of frequency and 60 bits of a hash each."""
    h = shingle_hashes(text, n)
    return np.unique((classes[h >> np.uint64(64 - CELL_BITS)] << np.uint64(ORDER_BITS)) | (h >> np.uint64(64 - ORDER_BITS)))


def frequency_classes(docs: DataFrame, n: int, text_col: str) -> np.ndarray:
    """The class of each cell from the occurrences in all documents; 2 ** CELL_BITS sums come to the driver."""

    def rows(found):
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in sliced(found, 0):
            cells = [shingle_hashes(text, n) >> np.uint64(64 - CELL_BITS) for text in batch.column(0).to_pylist()]
            if cells:
                total += np.bincount(np.concatenate(cells).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    counts = np.zeros(1 << CELL_BITS)
    for cell, n_cell in docs.select(docs[text_col].alias("text")).mapInArrow(rows, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        counts[cell] = n_cell
    mean = max(counts.mean(), 1e-9)
    return np.clip(np.floor(np.log2(np.maximum(counts, 1e-9) / (2 * mean))), 0, (1 << CLASS_BITS) - 1).astype(np.uint64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """For each of some classes of shingles whether the set has an odd number of them. Two sets' bitmaps of one length
    differ in no more bits than the sets in shingles; halves of a bitmap, one upon the other, are the next shorter one."""
    bits = max(BITS, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount((mixed(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def folded(bits: Column) -> Column:
    """The bitmap of half the length."""
    half = (F.size(bits) / 2).cast("int")
    return F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda u, v: u.bitwiseXOR(v))


def differing(x: Column, y: Column) -> Column:
    """In how many bits two sets' bitmaps differ, by the shorter one. Sets that can link have lengths that are equal or
    two to one."""
    short = F.least(F.size(x), F.size(y))
    x, y = (F.when(F.size(c) > short, folded(c)).otherwise(c) for c in (x, y))
    return F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda u, v: u + v)


def signature(shingles: np.ndarray) -> bytes | None:
    """128 bits of a set; an empty set has none."""
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def prefix_length(n: int, tenths: int = 9) -> int:
    """Shingles of the prefix of a set of n: n less the least overlap of a partner, plus one, plus one for each SHARE
    shingles. So partners share as many in their prefixes as the smaller set has in excess, plus one."""
    return n - (tenths * n + 9) // 10 + 1 + n // SHARE


def needs_partner(n: int, tenths: int = 9) -> bool:
    """Whether a set of n can link with another set: with one shingle more or fewer at least."""
    return n >= 1 and (10 * n >= tenths * (n + 1) or 10 * (n - 1) >= tenths * n)


def _profile(n: int, tenths: int, shared):
    def rows(found):
        classes = shared.value
        for batch in sliced(found, 2):
            sizes, signs, bitmaps, briefs, prefixes = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                s = ordered_set(text, n, classes)
                linked = needs_partner(len(s), tenths)
                sizes.append(len(s))
                signs.append(signature(s))
                bits = parity(s) if linked else None
                bitmaps.append(bits)
                briefs.append(np.bitwise_xor.reduce(bits.reshape(-1, BITS // 64)) if linked else None)
                prefixes.append(s[: prefix_length(len(s), tenths)].view(np.int64) if linked else [])
            columns = [pa.array(sizes, pa.int64()), pa.array(signs, pa.binary()), *(pa.array(b, pa.list_(pa.int64())) for b in (bitmaps, briefs)), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["row", "id", "n", "sign", "bits", "brief", "prefix"])

    return rows


def _sets(n: int, shared):
    """(id, sign, fragment, shingles) of the rows whose id passes the filter."""

    def rows(found):
        classes, bitmap = shared.value
        for batch in sliced(found, 2):
            hits = np.flatnonzero(in_filter(bitmap, batch.column(1).to_numpy()))
            ids, out = batch.column(0), []
            for k in hits.tolist():
                s = ordered_set(batch.column(2)[k].as_py(), n, classes)
                out += [(ids[k].as_py(), signature(s), f, part.view(np.int64)) for f, part in enumerate(np.split(s, np.searchsorted(s, CUTS))) if len(part)]
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=["lead", "sign", "fragment", "shingles"])

    return rows


class _Join:
    """The tables of one join; ``tenths``: the least Jaccard similarity in tenths."""

    def __init__(self, docs: DataFrame, n: int, tenths: int, id_col: str, text_col: str):
        self.n, self.tenths, self.context = n, tenths, docs.sparkSession.sparkContext
        self.rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
        self.classes = frequency_classes(self.rows, n, "text")
        self.profile = stage(
            self.rows.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(
                _profile(n, tenths, self.context.broadcast(self.classes)), "row long, id long, n long, sign binary, bits array<long>, brief array<long>, prefix array<long>"
            ),
            "profile",
        )
        first = self.profile.where("id IS NOT NULL AND n > 0").groupBy("sign").agg(F.min(F.struct("id", "row", "n")).alias("first"))
        again = F.row_number().over(Window.partitionBy("lead").orderBy("sign"))
        #: A node for each class: its smallest id, or a hash of the class where that id has had another text already.
        self.nodes = stage(
            first.select("sign", F.col("first.id").alias("lead"), F.col("first.row").alias("row"), F.col("first.n").alias("n"))
            .withColumn("node", F.when(again == 1, F.col("lead")).otherwise(F.xxhash64("sign"))),
            "nodes",
        )

    def required(self, a: str, b: str) -> Column:
        """The least overlap of two sets of those sizes: t / (1 + t) of their sum, rounded up."""
        return F.ceil(F.lit(self.tenths) * (F.col(a) + F.col(b)) / F.lit(10.0 + self.tenths) - 1e-9)

    def buckets(self) -> DataFrame:
        """(shingle, node, n, at, unshared): shingles that two classes or more have in their prefixes."""
        given = self.profile.where("size(prefix) > 0")
        # Tables that are joined with what was counted from them are written first: a join then deals both of its sides
        # itself, and the rows of a hot shingle can be split.
        key = F.xxhash64("sign")
        counted = given.select(key.alias("key"), F.explode("prefix").alias("shingle")).groupBy("shingle").agg(F.min("key").alias("u"), F.max("key").alias("v"), F.count(F.lit(1)).alias("df"))
        several = stage(counted.where("u < v").select("shingle", "df"), "shared-shingles")
        found = given.select("row", F.posexplode("prefix").alias("at", "shingle")).join(several, "shingle")
        # One row for each document: its prefix bounds the list. Of what partners share, more than the larger one's excess
        # at the smaller one's least size, the rarest is not among the most frequent of either's; so these can go.
        lists = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("df", "shingle", F.col("at").cast("long").alias("at")))).alias("shared"))
        prefix = F.col("n") - F.floor((self.tenths * F.col("n") + 9) / 10) + 1 + F.floor(F.col("n") / SHARE)
        unshared = (1000 * (prefix - F.size("shared")) / prefix).cast("int").alias("unshared")
        rarest = F.slice("shared", F.lit(1), F.greatest(F.size("shared") - self.left_out("n"), F.lit(0)).cast("int"))
        out = stage(self.nodes.join(lists, "row").select("node", "n", unshared, F.explode(rarest).alias("s")).select("s.shingle", "node", "n", "s.at", "unshared"), "buckets")
        unstage(several)
        return out

    def left_out(self, n: str) -> Column:
        """How many of its most frequent prefix shingles a set leaves out of buckets: no more than any partner has in excess."""
        return F.floor(self.tenths * F.col(n) / (10 * SHARE))

    def possible(self, a: str, b: str) -> Column:
        """Whether sizes and places of a shared shingle (columns n_, at_) allow the overlap."""
        na, nb, ia, ib = (F.col(x) for x in (f"n_{a}", f"n_{b}", f"at_{a}", f"at_{b}"))
        most = F.least(ia, ib) + 1 + F.least(na - ia - 1, nb - ib - 1)
        return (most >= self.required(f"n_{a}", f"n_{b}")) & (F.least(na, nb) * 10 >= F.greatest(na, nb) * self.tenths)

    def sets(self, likely: DataFrame) -> DataFrame:
        """(node, fragment, shingles) of the nodes in pairs."""
        nodes = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
        wanted = stage(self.nodes.join(nodes, "node", "left_semi").select("node", "lead", "sign"), "wanted")
        shared = self.context.broadcast((self.classes, key_filter(wanted, "lead")))
        made = self.rows.where("id IS NOT NULL").select("id", filter_place(F.col("id")).alias("at"), "text").mapInArrow(
            _sets(self.n, shared), "lead long, sign binary, fragment int, shingles array<long>"
        )
        # Rows that repeat an id and its text give the same set.
        out = stage(made.join(wanted, ["lead", "sign"]).groupBy("node", "fragment").agg(F.first("shingles").alias("shingles")), "sets")
        unstage(wanted)
        return out

    def verified(self, pairs: DataFrame, bits: DataFrame) -> DataFrame:
        """Those of the distinct pairs (a, n_a, b, n_b) that link."""
        a, b = bits.select(F.col("node").alias("a"), F.col("bits").alias("x")), bits.select(F.col("node").alias("b"), F.col("bits").alias("y"))
        near = differing(F.col("x"), F.col("y")) <= F.col("n_a") + F.col("n_b") - 2 * self.required("n_a", "n_b")
        likely = stage(pairs.join(a, "a").join(b, "b").where(near).select("a", "n_a", "b", "n_b"), "likely")
        if likely.isEmpty():
            return likely.select("a", "b")
        sets = self.sets(likely)
        of_a, of_b = (sets.select(F.col("node").alias(k), "fragment", F.col("shingles").alias(f"s_{k}")) for k in "ab")
        partial = likely.join(of_a, "a").join(of_b, ["b", "fragment"]).select("a", "n_a", "b", "n_b", F.size(F.array_intersect("s_a", "s_b")).alias("overlap"))
        total = partial.groupBy("a", "n_a", "b", "n_b").agg(F.sum("overlap").alias("overlap"))
        out = stage(total.where((10 + self.tenths) * F.col("overlap") >= self.tenths * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "links")
        unstage(likely, sets)
        return out

    def rest(self, work: DataFrame, bits: DataFrame) -> DataFrame:
        """Pairs of a bucket in different components. In a bucket of more than MANY the larger set's row is dealt by its
        size as well: partners are of its own class of sizes or the one below. Here bitmaps are folded to BITS.

        A pair that wasn't looked at yet is in no bucket whose centre is one of the two, so all shingles that it shares in
        the prefixes, but the most frequent ones, are in these buckets, and there must be enough of them."""
        size = F.floor(F.log("n") / math.log(1 / (self.tenths / 10 - 0.001))).cast("int")
        work = stage(work.join(bits.select("node", "brief"), "node").withColumn("size", F.when(F.col("members") > MANY, size).otherwise(-1)), "rest")
        sizes = F.when(F.col("size") < 0, F.array("size")).otherwise(F.array("size", F.col("size") + 1))
        right = work.select("shingle", F.explode(sizes).alias("size"), *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "at", "label", "brief")))
        left = work.select("shingle", "size", *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "at", "label", "brief")))
        differ = reduce(lambda u, v: u + v, (F.bit_count(F.get("brief_a", F.lit(k)).bitwiseXOR(F.get("brief_b", F.lit(k)))) for k in range(BITS // 64)))
        near = differ <= F.col("n_a") + F.col("n_b") - 2 * self.required("n_a", "n_b")
        smaller = F.struct("n_b", "node_b") < F.struct("n_a", "node_a")
        pairs = left.join(right, ["shingle", "size"]).where(smaller & (F.col("label_a") != F.col("label_b")) & self.possible("a", "b") & near)
        shared = pairs.groupBy(F.col("node_a").alias("a"), "n_a", F.col("node_b").alias("b"), "n_b").agg(F.count(F.lit(1)).alias("shared"))
        least = F.floor(F.least("n_a", "n_b") / SHARE) - F.greatest(self.left_out("n_a"), self.left_out("n_b"))
        return stage(shared.where(F.col("shared") > least).drop("shared"), "pairs")

    def distinct_pairs(self, pairs: DataFrame) -> DataFrame:
        return stage(pairs.select(F.col("node_a").alias("a"), "n_a", F.col("node_b").alias("b"), "n_b").distinct(), "pairs")

    def centred(self, centres: DataFrame, members: DataFrame) -> DataFrame:
        """The possible pairs of buckets' centres (columns of c) and members in different components."""
        centre = centres.select("shingle", *(F.col(f"c.{c}").alias(f"{c}_a") for c in ("node", "n", "at", "label", "unshared")))
        member = members.select("shingle", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "at", "label")))
        return centre.join(member, "shingle").where((F.col("label_a") != F.col("label_b")) & self.possible("a", "b"))

    def labels(self) -> DataFrame:
        """(node, label) of the nodes that have links."""
        buckets = self.buckets()
        members = self.nodes.join(buckets.select("node").distinct(), "node", "left_semi")
        bits = stage(self.profile.select("row", "bits", "brief").join(members.select("row", "node"), "row").select("node", "bits", "brief"), "bitmaps")
        rank = F.struct("unshared", "node", "n", "at", "label")
        alone = buckets.withColumn("label", F.col("node"))
        # First each member with the best of its buckets' centres.
        centres = stage(alone.groupBy("shingle").agg(F.min(rank).alias("c"), F.count(F.lit(1)).alias("members")).where("members > 1"), "centres")
        nearest = self.centred(centres, alone).groupBy("node_b").agg(F.min(F.struct("unshared_a", "node_a", "n_a", "n_b")).alias("c"))
        pairs = self.distinct_pairs(nearest.select("node_b", "c.node_a", "c.n_a", "c.n_b"))
        links = self.verified(pairs, bits)
        found = connected_components(links)
        unstage(pairs, centres)
        # Then all that are still apart with their buckets' centres, and with the best one outside of its component.
        open_ = stage(buckets.join(found, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
        best = stage(open_.groupBy("shingle", "label").agg(F.min(rank).alias("c"), F.count(F.lit(1)).alias("members")), "best")
        first = stage(best.groupBy("shingle").agg(F.min("c").alias("c"), F.min("label").alias("u"), F.max("label").alias("v"), F.sum("members").alias("members")).where("u < v"), "first")
        apart = best.join(first.select("shingle", F.col("c.label").alias("lead")), "shingle").where("label != lead")
        second = stage(apart.groupBy("shingle").agg(F.min("c").alias("c")), "second")
        pairs = self.distinct_pairs(self.centred(first.select("shingle", "c").unionByName(second), open_))
        more = self.verified(pairs, bits)
        unstage(pairs, best)
        # Last the pairs without a centre; buckets of up to three have none. Two of one component need no link.
        both = first.where("members > 3").select("shingle", "members", F.col("c.node").alias("one")).join(second.select("shingle", F.col("c.node").alias("two")), "shingle")
        large = stage(both, "large")
        others = open_.drop("label").join(large, "shingle").where("node != one AND node != two").drop("one", "two")
        links = stage(links.unionByName(more), "links")
        unstage(found)
        found = connected_components(links)
        others = stage(others.join(found, "node", "left").withColumn("label", F.coalesce("label", "node")), "others")
        several = stage(others.groupBy("shingle").agg(F.min("label").alias("u"), F.max("label").alias("v")).where("u < v").select("shingle"), "several")
        pairs = self.rest(others.join(several, "shingle", "left_semi"), bits)
        more = self.verified(pairs, bits)
        if not more.isEmpty():
            found = connected_components(links.unionByName(more))
        unstage(pairs, open_, first, second, large, others, several, buckets, bits)
        return found


def verdicts(docs: DataFrame, n: int, tenths: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, np.ndarray]:
    """(id, n, sign, component) for each row of ``docs``, as a staged table: what :func:`near_copies` tells, and the
    signature of the row's set; and the classes of frequency that signatures depend on."""
    work = _Join(docs, n, tenths, id_col, text_col)
    labels = work.labels()
    classes = stage(work.nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "classes")
    low = classes.groupBy("label").agg(F.min("lead").alias("component"))
    of_sign = stage(classes.join(low, "label").select("sign", "component"), "components")
    component = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component", "id"))
    out = stage(work.profile.select("id", "n", "sign").join(of_sign, "sign", "left").select("id", "n", "sign", component.alias("component")), "verdicts")
    unstage(classes, of_sign, labels, work.profile, work.nodes)
    return out, work.classes


def near_copies(docs: DataFrame, n: int = 3, tenths: int = 9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each row.

    A text's set has its distinct n-word shingles, or all of its words as one where they are fewer; sets link when
    their Jaccard similarity is ``tenths`` tenths or more. component_id is the smallest id that links reach. A text
    without words (null and empty ones too) links with nothing and is its own component. A row with a null id links
    with nothing and has a null component. Rows that repeat an id and its text are one document; texts of any length
    are whole, one at a time in memory. Other columns of ``docs`` are not read. An empty table gives an empty result.
    Ids are whole numbers.
    """
    found, _ = verdicts(docs, n, tenths, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, n: int = 5, tenths: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that a near copy with a smaller id stands for; all columns stay.

    Rows are judged by id and text: of two texts under one id, one may go and the other stay. Rows with a null id, and
    texts without words, stay. Only rows whose id passes a filter of the ids that go are compared; the others aren't
    moved. An empty table gives an empty result.
    """
    found, order = verdicts(docs, n, tenths, id_col, text_col)
    gone = stage(found.where("component < id").select(F.col("id").alias("gone_id"), F.col("sign").alias("gone_sign")).distinct(), "gone")
    unstage(found)
    shared = docs.sparkSession.sparkContext.broadcast((order, key_filter(gone, "gone_id")))
    width, text_at, extra = len(docs.columns), docs.columns.index(text_col), "sign_of_row"
    while extra in docs.columns:
        extra += "_"
    placed = docs.withColumn(extra, filter_place(docs[id_col].cast("long")))

    def clear(found):
        for batch in found:
            keep = ~in_filter(shared.value[1], batch.column(width).to_numpy())
            yield pa.RecordBatch.from_arrays(batch.columns[:width], names=batch.schema.names[:width]).filter(pa.array(keep))

    def signed(found):
        for batch in found:
            some = batch.filter(pa.array(in_filter(shared.value[1], batch.column(width).to_numpy())))
            signs = [signature(ordered_set(t, n, shared.value[0])) for t in some.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*some.columns[:width], pa.array(signs, pa.binary())], names=some.schema.names)

    compared = placed.mapInArrow(signed, StructType([*docs.schema.fields, StructField(extra, BinaryType())]))
    is_gone = (compared[id_col].cast("long") == gone["gone_id"]) & (compared[extra] == gone["gone_sign"])
    return placed.mapInArrow(clear, docs.schema).unionByName(compared.join(gone, is_gone, "left_anti").drop(extra))


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' ')) END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id JOIN sizes m ON m.doc_id = x.doc_id JOIN sizes n ON n.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, m.n, n.n HAVING 100 * count(*) >= 90 * (m.n + n.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reached JOIN links ON other = a
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
