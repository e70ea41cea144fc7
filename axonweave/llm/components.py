"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonweave.llm._tables import store


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (node, label): label is the smallest node that links reach. Nodes without links are absent.

    Each round every node takes the smallest label among its neighbours' and then its label's label, so rounds
    grow with the logarithm of a chain's length. Rounds are stored tables in the shared folder.
    """
    edges = store(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = store(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("m"))
        took = labels.join(near, labels.node == near.a).select("node", F.least("label", "m").alias("label"), F.col("label").alias("was"))
        took = store(took)
        up = took.select(F.col("node").alias("label"), F.col("label").alias("top"))
        labels = store(took.join(up, "label").select("node", F.least("label", "top").alias("label"), "was"))
        if labels.where("label <> was").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
