"""Connected components of a graph in tables: minimum labels, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import stage, unstage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the least node that links reach.

    Each round takes the least label among neighbours, then the label of that label, so that long chains shorten by
    half or more. Rounds are written to the shared folder, and go when the next one is; nothing but a count comes to
    the driver.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        new = stage(low.join(up, "low").select("node", F.least("low", "up").alias("label"), (F.least("low", "up") < F.col("old")).alias("moved")), "labels")
        unstage(labels)
        if new.where("moved").isEmpty():
            unstage(both)
            return new.drop("moved")
        labels = new
