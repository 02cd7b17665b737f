"""Nightly notice deltas: only new notices are sketched and compared; clusters and cards are carried forward.

The state is a folder of tables, one sub-folder per batch for what grows and one version per batch for what
changes. A batch that is replayed reads the version before it and writes its own again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import cards, clusters, linking, lsh
from lakemart.operators.corpus import membership, sketch
from lakemart.operators.similarity import verify
from lakemart.workspace import durable

GROUP_SCHEMA = (
    "group_id bigint, content_key string, n_shingles int, shingles array<bigint>, bands array<bigint>"
)
LABEL_SCHEMA = "doc_id bigint, group_id bigint, cluster_id bigint"


@dataclass(frozen=True)
class NoticeStore:
    """Tables below ``path``: ``groups`` (append), ``labels``, ``cards``, ``mapping``, ``redirects`` (versioned)."""

    spark: SparkSession
    path: str

    def _batch(self, table: str, batch: int) -> str:
        return f"{self.path}/{table}/batch={batch:08d}"

    def _read(self, table: str, batch: int, schema: str) -> DataFrame:
        if batch < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._batch(table, batch))

    def groups_before(self, batch: int) -> DataFrame:
        """Content groups of all earlier batches."""
        if batch == 0:
            return self.spark.createDataFrame([], GROUP_SCHEMA)
        every = self.spark.read.schema(GROUP_SCHEMA + ", batch string").option("basePath", f"{self.path}/groups")
        return every.parquet(f"{self.path}/groups").where(F.col("batch") < f"{batch:08d}").drop("batch")

    def labels(self, batch: int) -> DataFrame:
        return self._read("labels", batch, LABEL_SCHEMA)

    def card_state(self, batch: int) -> cards.CardState:
        return cards.CardState(
            self._read("cards", batch, cards.CARDS_SCHEMA), self._read("mapping", batch, cards.MAPPING_SCHEMA),
            self._read("redirects", batch, cards.REDIRECTS_SCHEMA),
        )

    def write(self, table: str, batch: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self._batch(table, batch))


def delta_pairs(fresh: DataFrame, stored: DataFrame, percent: int, cap: int = linking.BLOCK) -> DataFrame:
    """Verified pairs with at least one new group: new against old, and new against new.

    As in ``lsh.verified_pairs``, buckets are compared in blocks of about ``cap`` groups. Only buckets that a new group is in are
    looked at.
    """
    everything = stored.select(fresh.columns).withColumn("is_new", F.lit(False)).unionByName(
        fresh.withColumn("is_new", F.lit(True))
    )
    rows = everything.select("group_id", "n_shingles", "bands", "is_new", F.posexplode("bands").alias("band_id", "bucket_hash"))
    keys = ["band_id", "bucket_hash"]
    touched = rows.where("is_new").select(*keys).distinct()
    near = everything.join(rows.join(touched, keys, "left_semi").select("group_id").distinct(), "group_id", "left_semi")
    both = lsh.colliding_pairs(near.select("group_id", "n_shingles", "bands", "is_new"), percent, cap).where("x.is_new or y.is_new")
    pairs = both.select(
        F.least("x.group_id", "y.group_id").alias("group_a"), F.greatest("x.group_id", "y.group_id").alias("group_b")
    )
    return verify(pairs, everything, percent).select("group_a", "group_b")


def process_batch(store: NoticeStore, notices: DataFrame, batch: int, percent: int, as_of: str, **options) -> None:
    """Take one delta of ``notices(doc_id, text)`` into the store.

    Notices already known are skipped, so re-deliveries do no harm.
    """
    spark = store.spark
    before = store.labels(batch - 1)
    known_groups = store.groups_before(batch)
    new = notices.dropDuplicates(["doc_id"]).join(before.select("doc_id"), "doc_id", "left_anti")
    sketches = durable(sketch(new, **options), "delta-sketches")
    keys, _ = membership(sketches)
    known = known_groups.select("content_key", F.col("group_id").alias("known_id"))
    placed = durable(
        keys.join(known, "content_key", "left").select(
            "content_key", F.coalesce("known_id", "group_id").alias("group_id"),
            F.col("known_id").isNull().alias("is_new"),
        ), "delta-groups",
    )
    fresh = (
        sketches.drop("content_key").withColumnRenamed("doc_id", "group_id")
        .join(placed.where("is_new").select("group_id", "content_key"), "group_id")
        .select("group_id", "content_key", "n_shingles", "shingles", "bands")
    )
    store.write("groups", batch, fresh)
    fresh = spark.read.schema(GROUP_SCHEMA).parquet(store._batch("groups", batch))

    # Clusters: new groups begin alone; each new pair may join the clusters of its two groups.
    arrivals = sketches.select("doc_id", "content_key").join(placed, "content_key").select("doc_id", "group_id")
    old_clusters = before.select("group_id", "cluster_id").distinct()
    arrived_clusters = arrivals.select("group_id").distinct().join(old_clusters, "group_id", "left").select(
        "group_id", F.coalesce("cluster_id", "group_id").alias("cluster_id")
    )
    cluster_of = old_clusters.unionByName(
        arrived_clusters.join(old_clusters.select("group_id"), "group_id", "left_anti")
    )
    pairs = delta_pairs(fresh, known_groups, percent)
    joined = (
        pairs.join(cluster_of.select(F.col("group_id").alias("group_a"), F.col("cluster_id").alias("cluster_a")), "group_a")
        .join(cluster_of.select(F.col("group_id").alias("group_b"), F.col("cluster_id").alias("cluster_b")), "group_b")
        .select("cluster_a", "cluster_b")
    )
    merged = clusters.components(joined, "cluster_a", "cluster_b")
    labels = (
        before.select("doc_id", "group_id").unionByName(arrivals).join(cluster_of, "group_id")
        .join(merged, F.col("cluster_id") == F.col("node"), "left")
        .select("doc_id", "group_id", F.coalesce("cluster", "cluster_id").alias("cluster_id"))
    )
    store.write("labels", batch, labels)
    found = store.labels(batch).select(F.col("doc_id").alias("notice_id"), "cluster_id")
    state = cards.update_cards(store.card_state(batch - 1), found, as_of)
    store.write("cards", batch, state.cards)
    store.write("mapping", batch, state.mapping)
    store.write("redirects", batch, state.redirects)


def run(
    stream: DataFrame, store: NoticeStore, checkpoint: str, percent: int, as_of: Callable[[int], str], **options
) -> None:
    """Process the deltas that have arrived, one micro-batch each, and stop; ``as_of`` dates a batch by its number."""

    def each(batch: DataFrame, number: int) -> None:
        process_batch(replace(store, spark=batch.sparkSession), batch, number, percent, as_of(number), **options)

    query = (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def last_batch(store: NoticeStore) -> int:
    """Number of the newest version of the mapping."""
    versions = store.spark.read.schema(cards.MAPPING_SCHEMA + ", batch string").parquet(f"{store.path}/mapping")
    return int(versions.agg(F.max("batch")).first()[0])
