"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node that can be reached.

    Each round takes the least label among the neighbours, then the label of that label. Both
    are joins and aggregates on keys, stored in the shared folder between rounds; labels only
    fall, and the rounds end when none did.
    """
    both = cut_lineage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a IS NOT NULL AND b IS NOT NULL").distinct()
    )
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")))
    while True:
        spread = (
            both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        )
        lower = labels.join(spread, labels.node == spread.a).select(
            "node", "component", F.least("component", "near").alias("label")
        )
        heads = lower.select(F.col("node").alias("label"), F.col("label").alias("head"))
        jumped = cut_lineage(
            lower.join(heads, "label", "left")
            .select("node", F.least("label", "head").alias("component"), (F.least("label", "head") < F.col("component")).alias("fell"))
        )
        labels = jumped.drop("fell")
        if jumped.where("fell").isEmpty():
            return labels
