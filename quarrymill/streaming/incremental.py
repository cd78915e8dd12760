"""Incremental cleaning: new files are picked up by a stream, and urls that were met before are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarrymill.operators import quality, ranking
from quarrymill.sources.files import SCHEMAS


def clean_stream(spark: SparkSession, source: str, target: str, checkpoint: str, rules: quality.CleanRules = quality.CleanRules()) -> StreamingQuery:
    """Cleans files as they come, and stops when all are read; a later call goes on with the new ones.

    A batch keeps the first row of each url that no earlier batch has had (whether it passes the rules or not, as in
    the batch operator), and writes those that pass. A batch that is run again after a failure overwrites its own
    folders, so that results are written once.
    """
    pages = spark.readStream.schema(SCHEMAS["raw_pages"]).json(source).withColumn("source_file", F.col("_metadata.file_path"))

    def batch(rows: DataFrame, number: int) -> None:
        seen = f"{target}/seen"
        fresh = rows.where(F.coalesce("url", F.lit("")) != "")
        if number:
            known = spark.read.schema("url string, batch long").parquet(seen).where(F.col("batch") < number)
            fresh = ranking.without_known(fresh, known, "url")
        fresh = fresh.withColumn("line_no", F.monotonically_increasing_id())
        first = quality.first_seen(fresh, F.col("url"), ["source_file", "line_no"]).persist()
        try:
            first.select("url").write.mode("overwrite").parquet(f"{seen}/batch={number}")
            good = quality.clean_pages(first, rules)
            good.drop("source_file", "line_no").write.mode("overwrite").json(f"{target}/cleaned/batch={number}")
        finally:
            first.unpersist()

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, width: str = "1 hour", late: str = "10 minutes", time: str = "ts", by: str = "event_type") -> DataFrame:
    """Counts and sums of events by time window, of a stream or a table; events later than ``late`` are left out of a
    stream's closed windows. A stream's time may be without a zone; it is the session's then."""
    watched = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late) if events.isStreaming else events
    return watched.groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("window_start"), by, "n", "total"
    )
