"""The notice jobs end to end: sketches, candidates, verification, clusters, cards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import cards, clusters, linking, similarity
from lakemart.operators.corpus import Corpus, build_corpus
from lakemart.sources.tables import table
from lakemart.workspace import durable, spread

SIMILAR_PERCENT = 80


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def title_and_body(notices: DataFrame) -> DataFrame:
    """The first line as title, the rest as body."""
    return notices.select(
        "*", F.substring_index("text", "\n", 1).alias("title"),
        F.substr("text", F.char_length(F.substring_index("text", "\n", 1)) + 2).alias("body"),
    )


def neighbour_pairs(notices: DataFrame) -> DataFrame:
    """Pairs to measure the estimator on: each notice with the next id, and with the first of its opening line.

    Two pairs per notice at most, whatever the corpus looks like.
    """
    ids = notices.select("doc_id")
    next_one = ids.withColumn("next_id", F.col("doc_id") + 1).join(
        ids.withColumnRenamed("doc_id", "next_id"), "next_id", "left_semi"
    ).select(F.col("doc_id").alias("doc_a"), F.col("next_id").alias("doc_b"))
    opening = notices.select("doc_id", F.xxhash64(F.substring_index("text", "\n", 1)).alias("opening"))
    first = opening.groupBy("opening").agg(F.min("doc_id").alias("doc_a"))
    same_opening = opening.join(first, "opening").where(F.col("doc_a") < F.col("doc_id")).select(
        "doc_a", F.col("doc_id").alias("doc_b")
    )
    return next_one.unionByName(same_opening).distinct()


def scored_neighbours(spark: SparkSession, folder: str, k: int = 3) -> DataFrame:
    from lakemart.operators.corpus import sketch

    notices = documents(spark, folder)
    sketches = durable(sketch(notices, k=k), "sketches")
    scored = similarity.score_pairs(neighbour_pairs(notices), sketches)
    label = F.when(F.col("jaccard") >= SIMILAR_PERCENT / 100, F.lit("same")).otherwise(F.lit("different"))
    return scored.withColumn("label", label)


def exact_clusters(corpus: Corpus, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """Clusters of all pairs at or above ``percent``, found without writing all of them."""
    buckets = durable(similarity.prefix_buckets(corpus.group_sets, percent), "prefix-buckets")
    links = linking.connect(buckets, corpus.sets, percent, ["shingle"])
    return clusters.cluster_notices(corpus.members, clusters.components(links))


@dataclass(frozen=True)
class NoticeRun:
    """``links`` are enough of the verified pairs to connect each cluster; ``lsh.verified_pairs`` gives all of them."""

    corpus: Corpus
    links: DataFrame
    clusters: DataFrame


def run_notices(notices: DataFrame, percent: int = SIMILAR_PERCENT, **options) -> NoticeRun:
    """The nightly job: sketch, candidate buckets, exact verification, clusters."""
    corpus = build_corpus(notices, **options)
    links = linking.connect(band_buckets(corpus.groups), corpus.sets, percent, BUCKET)
    return NoticeRun(corpus, links, clusters.cluster_notices(corpus.members, clusters.components(links)))


BUCKET = ("band_id", "bucket_hash")


def band_buckets(groups: DataFrame) -> DataFrame:
    """``(band_id, bucket_hash, group_id, n_shingles)``."""
    return groups.select(F.posexplode("bands").alias(*BUCKET), "group_id", "n_shingles")


@dataclass(frozen=True)
class CardHistory:
    state: cards.CardState
    issued: DataFrame


def replay_cards(corpus: Corpus, night_of: DataFrame, n_nights: int, percent: int = SIMILAR_PERCENT) -> CardHistory:
    """Cards after ``n_nights`` re-runs on a growing corpus, each on everything that had arrived by then.

    ``night_of(doc_id, night)``. Each night compares the content groups that are new with those present, carries the clusters
    on and updates the cards.
    """
    spark = night_of.sparkSession
    state, issued = cards.empty_state(spark), None
    members = durable(corpus.members.join(night_of, "doc_id"), "arrivals")
    since = members.groupBy("group_id").agg(F.min("night").alias("since"))
    buckets = durable(band_buckets(corpus.groups).join(since, "group_id"), "arrived-buckets")
    labels = None
    for night in range(1, n_nights + 1):
        there = buckets.where(F.col("since") <= night).withColumn("is_new", F.col("since") == night)
        joined = clusters.components(linking.connect(there, corpus.sets, percent, BUCKET, labels), "from_a", "from_b")
        fresh = since.where(F.col("since") == night).select(F.col("group_id").alias("at"), F.col("group_id").alias("was"))
        if labels is not None:
            fresh = labels.select(F.col("node").alias("at"), F.col("cluster").alias("was")).unionByName(fresh)
        labels = durable(
            fresh.join(joined, F.col("was") == F.col("node"), "left").select(F.col("at").alias("node"), F.coalesce("cluster", "was").alias("cluster")),
            "clusters",
        )
        found = clusters.cluster_notices(members.where(F.col("night") <= night), labels)
        found = found.select(F.col("doc_id").alias("notice_id"), "cluster_id")
        state = cards.update_cards(state, found, f"2024-01-{night:02d} 00:00:00").durable()
        tonight = state.mapping.select("card_id", "notice_id")
        issued = tonight if issued is None else issued.unionByName(tonight)
    return CardHistory(state, issued.distinct())
