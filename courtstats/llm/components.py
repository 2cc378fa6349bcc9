"""Connected components of a graph of links, on Spark."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.sources.shared import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of ``links``; the label is the smallest node.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so paths shorten by doubling. Rounds are written to the shared
    folder; only one number of each reaches the driver.
    """
    edges = stage(
        links.select(F.col(a).alias("x"), F.col(b).alias("y"))
        .unionAll(links.select(F.col(b).alias("x"), F.col(a).alias("y")))
        .distinct(),
        "edges",
    )
    labels = stage(
        edges.groupBy(F.col("x").alias("node")).agg(
            F.least(F.min("y"), F.col("x")).alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "y"), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node", "left").select(
            "node",
            F.col("label").alias("old"),
            F.least("label", F.coalesce("near", "label")).alias("low"),
        )
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        found = stage(
            lower.join(jump, "low", "left").select(
                "node", "old", F.least("low", F.coalesce("far", "low")).alias("label")
            ),
            "labels",
        )
        labels = found.select("node", "label")
        if found.where("label <> old").isEmpty():
            return labels
