"""Sinks: JSON lines by run or by input file, and the index tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite", by: str | None = None) -> None:
    """One object a line, null fields kept and text as it is; ``by``: a folder for each value, as for each input file."""
    writer = rows.write.mode(mode).option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def by_input(rows: DataFrame, path: str, file: str = "source_file") -> None:
    """Rows to folders named after their input files."""
    write_jsonl(rows.withColumn("input", F.regexp_extract(file, r"([^/]+)\z", 1)).drop(file), path, by="input")


def write_index(chunks: DataFrame, entities: DataFrame, relations: DataFrame, path: str, recreate: bool = False) -> None:
    """The three tables of an index, written anew or added to. Chunks are keyed by a hash of their text, entities and
    relations by all of their columns: what is there already isn't added again."""
    keyed = chunks.withColumn("chunk_key", F.sha2("content", 256))
    for name, table, keys in (("chunks", keyed, ["chunk_key"]), ("entities", entities, entities.columns), ("relations", relations, relations.columns)):
        place, new = f"{path}/{name}", table.dropDuplicates(keys)
        if not recreate and exists(table.sparkSession, place):
            known = table.sparkSession.read.parquet(place)
            same = [table[k].eqNullSafe(known[k]) for k in keys]
            new = new.join(known.select(keys), reduce(lambda u, v: u & v, same), "left_anti") if keys != ["chunk_key"] else new.join(known.select(keys), keys, "left_anti")
        new.write.mode("overwrite" if recreate else "append").parquet(place)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def write_schemes(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object for each scheme, in a folder of its faculty and its own: (faculty, scheme) and the record's other
    columns. A later run replaces the schemes that it has, and leaves the others alone."""
    spark = rows.sparkSession
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.write.mode(mode).option("ignoreNullFields", "false").partitionBy("faculty", "scheme").json(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
