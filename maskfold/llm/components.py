"""Connected components of links between hashed ids, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskfold.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """(node, label): for each end of a link (a, b) the smallest node that it reaches.

    In each round a node takes the smallest label among its neighbours', then its label's own label, so
    that chains halve; a round's labels are written, which ends its lineage. Labels only fall, and the
    rounds end when none does. Nothing but that fact reaches the driver."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a != b").distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("onward"))
        after = written(low.join(own, "label", "left").select("node", "was", F.least("label", F.coalesce("onward", "label")).alias("label")))
        labels = after.select("node", "label")
        if after.where("was != label").isEmpty():
            return labels
