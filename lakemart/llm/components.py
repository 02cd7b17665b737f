"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.workspace import durable, durable_observed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; a component's id is its smallest node.

    Each round gives a node the least label among its neighbours and then the label of that label, until no label
    moves. A label is a sum-like minimum, combined before it is shuffled; labels and links are joined from written
    tables, so a node with very many links is split by the skew join. The driver sees one count a round.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    edges = durable(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = durable(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("least"))
        lower = durable(
            labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("component").alias("was"), F.least("component", "least").alias("component")),
            "labels",
        )
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels, seen = durable_observed(
            lower.join(jump, "component").select("node", "was", F.col("further").alias("component")), "labels",
            F.count_if(F.col("component") != F.col("was")).alias("moved"),
        )
        labels = labels.select("node", "component")
        if not seen["moved"]:
            return labels
