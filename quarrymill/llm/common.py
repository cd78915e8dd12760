"""What the operators of this package share: tables, tables written between stages, words as hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.session import shared_dir

#: Words are split at these bytes alone: space and \t \n \v \f \r, which is where bytes.split() splits.
WORD_SPACE = r"[\x20\x09-\x0D]+"
#: Bits of a filter of keys: 2 MB, whatever the input. Where many keys fill it, it lets more rows through.
FILTER_BITS = 1 << 24
_C = ctypes.CDLL(None)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps don't repeat it, and it outlives executors.

    ``by`` names a column whose values get folders of their own. The shuffle files of the write go when it is done; the
    table goes with ``unstage``, or when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    system, place = _place(spark, path)
    system.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(*tables: DataFrame | None) -> None:
    """Deletes staged tables that nothing reads any more; others, and None, are left alone."""
    for found in tables:
        if path := getattr(found, "_staged_at", None):
            system, place = _place(found.sparkSession, path)
            system.delete(place, True)


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id's text leaves 2 on division by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def filter_place(key: Column) -> Column:
    """The place of a key in a filter."""
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """A bitmap with the places of all keys, made by Spark; no more than FILTER_BITS bits come to the driver."""
    at = filter_place(F.col(key))
    found = keys.select(at.alias("at")).groupBy((F.col("at") / 32768).cast("long").alias("block")).agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for block, bits in found.collect():
        out[block * 4096 : block * 4096 + len(bits)] = np.frombuffer(bytes(bits), np.uint8)
    return out


def in_filter(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether keys with those places may be among the filter's; false only where they aren't."""
    return (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in UTF-8; ``lower`` lower-cases A-Z alone."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` words, in order; of all words as one run where there are fewer."""
    n = min(n, len(words))
    if not n:
        return words
    count = len(words) - n + 1
    out = words[:count].copy()
    for k in range(1, n):
        out = mixed(out) + words[k : k + count]
    return mixed(out)


def sliced(rows: Iterator, column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices whose texts have ``most`` bytes, or one row: what is made of a slice stays small."""
    for batch in rows:
        if not batch.num_rows:
            yield batch
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, most + (sizes[at - 1] if at else 0), side="right")))
            yield batch.slice(at, end - at)
            at = end
    # Workers stay for later tasks: what Arrow and the C library keep in reserve goes back.
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)
