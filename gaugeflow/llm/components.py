"""Connected components of links between ids, as Spark joins; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, label): the smallest id of its component, for every id in ``links`` (a, b).

    Each round takes the least label among neighbours and then the label of that label, so
    the rounds grow with the logarithm of the longest chain.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(spark, both.distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
    labels = labels.withColumn("label", F.least("id", "label"))
    labels = stage(spark, labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(
            F.col("a").alias("id")
        ).agg(F.min("label").alias("near"))
        moved = labels.join(near, "id").withColumn("new", F.least("label", "near"))
        jump = moved.select(F.col("id").alias("new"), F.col("new").alias("far"))
        after = moved.join(jump, "new").select(
            "id", F.least("new", "far").alias("label"),
            (F.least("new", "far") != F.col("label")).alias("changed"),
        )
        after = stage(spark, after, "labels")
        labels = after.select("id", "label")
        if after.filter("changed").isEmpty():
            return labels
