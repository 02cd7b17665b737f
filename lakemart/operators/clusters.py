"""Clusters from duplicate pairs, and their profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.workspace import durable_observed


def _written(links: DataFrame) -> tuple[DataFrame, dict]:
    """The links as a table, with a count and a checksum that tell whether a round changed anything."""
    return durable_observed(
        links, "links", F.count("*").alias("n"),
        F.sum(F.xxhash64("node", "parent").cast("decimal(28,0)")).alias("checksum"),
    )


def _relink(edges: DataFrame) -> DataFrame:
    """Hang every neighbour larger than a node on the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("parent").alias("node"), F.col("node").alias("parent")))
    least = both.groupBy("node").agg(F.min("parent").alias("least")).select("node", F.least("node", "least").alias("least"))
    return (
        both.join(least, "node").where(F.col("parent") > F.col("node"))
        .select(F.col("parent").alias("node"), F.col("least").alias("parent")).distinct()
    )


def _gather(edges: DataFrame) -> DataFrame:
    """Hang a node and all its smaller neighbours on the smallest of them."""
    least = edges.groupBy("node").agg(F.min("parent").alias("least"))
    moved = edges.join(least, "node").where(F.col("parent") != F.col("least")).select(
        F.col("parent").alias("node"), F.col("least").alias("parent")
    )
    return moved.unionByName(least.withColumnRenamed("least", "parent")).distinct()


def components(edges: DataFrame, a: str = "group_a", b: str = "group_b") -> DataFrame:
    """``(node, cluster)`` for every node of the edge list; a cluster's id is its smallest node.

    Rounds of re-hanging nodes on smaller ones until nothing moves; their number grows with the logarithm of
    the longest chain. Each round is sums and joins on node ids and ends in a written table; the driver
    sees one count and one checksum.
    """
    links = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("parent")
    ).distinct()
    links, mark = _written(links)
    while mark["n"]:
        links, after = _written(_gather(_relink(links)))
        if after == mark:
            break
        mark = after
    roots = links.select(F.col("parent").alias("node")).distinct()
    return links.select("node", F.col("parent").alias("cluster")).unionByName(
        roots.withColumn("cluster", F.col("node"))
    )


LONGEST_CHAIN_BITS = 40


def follow(links: DataFrame, node: str, parent: str) -> DataFrame:
    """``(node, cluster)``: where each node's chain of links ends, by pointer jumping: what is left of a chain halves in each round.

    A node has at most one link; ends have none and get no row. Links that run in a circle raise an error, found by still
    moving after more rounds than any chain of 2^40 links takes.
    """
    at = links.select(F.col(node).alias("node"), F.col(parent).alias("cluster"))
    for _ in range(LONGEST_CHAIN_BITS):
        further = at.select(F.col("node").alias("cluster"), F.col("cluster").alias("_further"))
        moved = at.join(further, "cluster", "left").select(
            "node", F.coalesce("_further", "cluster").alias("cluster"), F.col("_further").isNotNull().alias("_moved"),
            (F.coalesce("_further", "cluster") == F.col("node")).alias("_back"),
        )
        at, seen = durable_observed(moved, "chains", F.count_if("_moved").alias("moved"), F.count_if("_back").alias("back"))
        at = at.drop("_moved", "_back")
        if seen["back"]:
            break
        if not seen["moved"]:
            return at
    raise ValueError("links run in a circle")


def cluster_notices(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, cluster_id)`` for every notice; one without duplicates is a cluster of its own."""
    return members.join(labels, F.col("group_id") == F.col("node"), "left").select(
        "doc_id", F.coalesce("cluster", "group_id").alias("cluster_id")
    )


def cluster_profile(notices: DataFrame, value: str, archetype: str) -> DataFrame:
    """Per cluster size: clusters, notices, duplicate pairs, and how many clusters disagree on ``value`` or mix
    more than two archetypes."""
    per_cluster = notices.groupBy("cluster_id").agg(
        F.count("*").alias("size"), F.countDistinct(value).alias("values"), F.countDistinct(archetype).alias("archetypes")
    )
    n = F.col("size")
    return per_cluster.groupBy("size").agg(
        F.count("*").alias("clusters"), F.sum("size").alias("notices"),
        F.sum(F.floor(n * (n - 1) / 2)).cast("bigint").alias("duplicate_pairs"),
        F.count_if(F.col("values") > 1).alias("value_conflicts"),
        F.count_if(F.col("archetypes") > 2).alias("mixed_clusters"),
    )


def base_rate(profile: DataFrame) -> DataFrame:
    """Duplicate pairs as a share of all possible pairs."""
    total = F.sum("notices")
    return profile.agg(
        total.alias("notices"), F.sum("duplicate_pairs").alias("duplicate_pairs"),
        (F.sum("duplicate_pairs") / (total.cast("double") * (total - 1) / 2)).alias("base_rate"),
    )


def larger_clusters(notices: DataFrame, minimum: int = 2) -> DataFrame:
    """Notices of clusters with at least ``minimum`` members."""
    wanted = notices.groupBy("cluster_id").agg(F.count("*").alias("n")).where(F.col("n") >= minimum)
    return notices.join(wanted.select("cluster_id"), "cluster_id", "left_semi")


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), key)
