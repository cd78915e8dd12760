"""Orders, samples, shards and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions import text as T


def after_offsets(rows: DataFrame, offsets: DataFrame, file: str = "source_file", line: str = "line_no") -> DataFrame:
    """Rows beyond the last line that was read of their file; files without an offset are read whole. Offsets are one
    row a file, and the join is an ordinary one: neither side has to fit anywhere."""
    read = offsets.select(F.col(file).alias("_file"), F.col("line_offset").alias("_read"))
    return rows.join(read, rows[file] == read["_file"], "left").where(F.col(line) > F.coalesce("_read", F.lit(0))).drop("_file", "_read")


def interleaved(rows: DataFrame, batch: int, file: str = "source_file", line: str = "line_no") -> DataFrame:
    """Adds round, file_ordinal and place: files take turns with ``batch`` rows each. Rows count within their file, so
    files are sorted apart; the order is a range sort by (round, file_ordinal, place)."""
    # Hot files: a file's rows are numbered in blocks, so that a file of any size is many tasks.
    block = F.floor(F.col(line) / BLOCK)
    sizes = rows.groupBy(file, block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(file).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(file, "_block", F.coalesce(before, F.lit(0)).alias("_before"))
    files = rows.select(file).distinct().select(file, (F.row_number().over(Window.orderBy(file)) - 1).alias("file_ordinal"))
    within = F.row_number().over(Window.partitionBy(file, "_block").orderBy(line)) - 1
    placed = rows.withColumn("_block", block).join(starts, [file, "_block"]).withColumn("place", F.col("_before") + within)
    return (
        placed.join(files, file).withColumn("round", F.floor(F.col("place") / batch)).drop("_block", "_before")
        .withColumn("file_ordinal", F.col("file_ordinal").cast("long")).withColumn("place", F.col("place").cast("long"))
    )


#: Lines of a block of a file in :func:`interleaved`.
BLOCK = 100_000


def by_density(rows: DataFrame, content: Column, order: list[str]) -> DataFrame:
    """Rows with their information density, the densest first and ties in order."""
    return rows.withColumn("density", T.density(content)).orderBy(F.desc("density"), *order)


def pool_size(total: int, k: int, ratio: float = 2.0, most: float = 0.3) -> int:
    """How many of the densest rows a sample of k is drawn from: ratio times k, ``most`` of all, but k at least."""
    return min(max(k, int(k * ratio)), max(k, int(total * most)))


def density_pool(rows: DataFrame, content: Column, k: int, ratio: float, order: list[str]) -> DataFrame:
    """The candidates of :func:`smart_sample`."""
    return by_density(rows, content, order).limit(pool_size(rows.count(), k, ratio))


def sample(rows: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """k rows by the MD5 of seed and key: the same ones in every run and on every engine, each as likely as another."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(k)


def smart_sample(rows: DataFrame, content: Column, k: int, ratio: float, key: str, seed: int = 42) -> DataFrame:
    """k rows drawn from the densest ones."""
    return sample(density_pool(rows, content, k, ratio, [key]), k, key, seed)


def sharded(rows: DataFrame, ordinal: Column, parts: int) -> DataFrame:
    """Round-robin shards by an ordinal."""
    return rows.withColumn("shard", F.pmod(ordinal, F.lit(parts)).cast("long"))


def kept_report(rows: DataFrame, kept: Column, by: str) -> DataFrame:
    """Counts and the kept ratio in percent for each group."""
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"), F.sum(kept.cast("long")).alias("kept"), F.round(100.0 * F.sum(kept.cast("long")) / F.count(F.lit(1)), 2).alias("kept_percent")
    )


def insert_batch(most_async: int = 128, divisor: int = 1) -> int:
    return min(64, max(16, most_async // divisor))


def pages_before_gap(pages: DataFrame, site: str = "site", page: str = "page_no", links: str = "n_links", gap: int = 3) -> DataFrame:
    """Pages of a list up to its first ``gap`` pages in a row without links, those included. A list is one site's pages."""
    w = Window.partitionBy(site).orderBy(page)
    empty = F.when(F.col(links) == 0, 1).otherwise(0)
    run = F.sum(empty).over(w.rowsBetween(-(gap - 1), 0))
    stopped = F.max((run >= gap).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return pages.withColumn("_over", F.coalesce(stopped, F.lit(0))).where("_over = 0").drop("_over")


def without_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't known yet."""
    return rows.join(known.select(F.col(key).alias("_known")), F.col(key) == F.col("_known"), "left_anti")
