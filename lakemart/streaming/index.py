"""Nightly notice deltas on an index that only grows: a night reads what its notices touch and writes what it adds.

Every table is laid out by batch and by a range of its key's hash. A delta's keys name the ranges it can meet, at most
``RANGES`` numbers, and these become partition filters: other ranges are not listed, opened or rewritten. Clusters are a forest
of parent links; a group gets its link when it comes or when its cluster joins an older one, once in its life. A card belongs
to the root of a cluster, so notices never move: their card is found over group and root.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import clusters, linking
from lakemart.operators.corpus import membership, sketch
from lakemart.plans.notices import BUCKET
from lakemart.workspace import durable, durable_by, durable_observed

RANGES = 64

# The tables and their columns.
TABLES = {
    "notices": "notice_id bigint, group_id bigint",
    "contents": "content_key string, group_id bigint",
    "bands": "band_id int, bucket_hash bigint, group_id bigint, n_shingles int",
    "sets": "group_id bigint, n_shingles int, parity binary, shingles array<bigint>",
    "parents": "node bigint, parent bigint",
    "cards": "cluster_id bigint, card_id string, canonical_notice_id bigint, created_at timestamp_ntz, updated_at timestamp_ntz",
    "redirects": "deprecated_card_id string, active_card_id string, merged_at timestamp_ntz",
}
KEYS = {
    "notices": ("notice_id",), "contents": ("content_key",), "bands": BUCKET, "sets": ("group_id",), "parents": ("node",),
    "cards": ("cluster_id",), "redirects": ("deprecated_card_id",),
}


@dataclass(frozen=True)
class DeltaStore:
    """The tables below ``path``. A batch that is replayed replaces its own part of each."""

    spark: SparkSession
    path: str
    ranges: int = RANGES

    def range_of(self, *keys: str | Column) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.ranges)).cast("int")

    def touched(self, df: DataFrame, *keys: str) -> list[int]:
        """The ranges that keys of ``df`` fall in."""
        return sorted(r[0] for r in df.select(self.range_of(*keys)).distinct().collect())

    def read(self, table: str, before: int, ranges: list[int] | None = None) -> DataFrame:
        """A table's rows of batches before a number, in the given ranges or in all."""
        columns = TABLES[table]
        if before <= 0:
            return self.spark.createDataFrame([], columns)
        found = self.spark.read.schema(f"{columns}, batch int, range int").parquet(f"{self.path}/{table}")
        found = found.where(F.col("batch") < before)
        if ranges is not None:
            found = found.where(F.col("range").isin(ranges))
        return found.drop("batch", "range")

    def lookup(self, table: str, before: int, wanted: DataFrame) -> DataFrame:
        """A table's rows whose keys ``wanted`` (columns named like the keys) has; only the ranges of these are read."""
        keys = list(KEYS[table])
        wanted = wanted.select(*keys)
        return self.read(table, before, self.touched(wanted, *keys)).join(wanted.distinct(), keys, "left_semi")

    def write(self, table: str, batch: int, df: DataFrame) -> None:
        names = [c.split()[0] for c in TABLES[table].split(", ")]
        placed = df.select(*names).withColumn("range", self.range_of(*KEYS[table]))
        placed.repartition("range").sortWithinPartitions("range", *KEYS[table]).write.mode("overwrite").partitionBy("range").parquet(
            f"{self.path}/{table}/batch={batch}"
        )


def roots_of(store: DeltaStore, before: int, nodes: DataFrame) -> DataFrame:
    """``(node, cluster)`` for given nodes: each step looks up the links of what was reached, until nothing has one."""
    at = nodes.select("node", F.col("node").alias("cluster")).distinct()
    while True:
        links = store.lookup("parents", before, at.select(F.col("cluster").alias("node"))).select(F.col("node").alias("cluster"), "parent")
        at, seen = durable_observed(
            at.join(links, "cluster", "left").select("node", F.coalesce("parent", "cluster").alias("cluster"), F.col("parent").isNotNull().alias("_moved")),
            "roots", F.count_if("_moved").alias("moved"),
        )
        at = at.drop("_moved")
        if not seen["moved"]:
            return at


def process_delta(store: DeltaStore, notices: DataFrame, batch: int, percent: int, as_of: str, **options) -> None:
    """Take one delta of ``notices(doc_id, text)`` into the store. Notices already known are skipped."""
    ids = notices.select(F.col("doc_id").alias("notice_id"))
    known = store.lookup("notices", batch, ids).select(F.col("notice_id").alias("doc_id"))
    new = notices.dropDuplicates(["doc_id"]).join(known, "doc_id", "left_anti")
    sketches = durable_by(sketch(new, **options).drop("signature"), "delta-sketches", "doc_id")
    keys, _ = membership(sketches)
    keys = durable(keys, "delta-keys")
    stored = store.lookup("contents", batch, keys).select("content_key", F.col("group_id").alias("known_id"))
    placed = durable(keys.join(stored, "content_key", "left").select(
        "content_key", F.coalesce("known_id", "group_id").alias("group_id"), F.col("known_id").isNull().alias("is_new")
    ), "delta-groups")
    arrivals = durable(sketches.select(F.col("doc_id").alias("notice_id"), "content_key").join(placed, "content_key").select("notice_id", "group_id"), "delta-notices")
    fresh = sketches.withColumnRenamed("doc_id", "group_id").drop("content_key").join(
        placed.where("is_new").select("group_id", "content_key"), "group_id"
    )
    own_bands = fresh.select(F.posexplode("bands").alias(*BUCKET), "group_id", "n_shingles")

    # Clusters: what shares a bucket with a new group, from the touched ranges, and what is new.
    met = durable(store.lookup("bands", batch, own_bands), "delta-met")
    rows = met.withColumn("is_new", F.lit(False)).unionByName(own_bands.withColumn("is_new", F.lit(True)))
    old_nodes = met.select(F.col("group_id").alias("node")).unionByName(
        arrivals.join(placed.where("not is_new"), "group_id", "left_semi").select(F.col("group_id").alias("node"))
    )
    start = roots_of(store, batch, old_nodes)
    old_sets = store.lookup("sets", batch, met)
    sets = durable_by(old_sets.unionByName(fresh.select(*old_sets.columns)), "delta-sets", "group_id")  # moved once, looked up in each round
    links = linking.connect(rows, sets, percent, BUCKET, start)
    merged = durable(clusters.components(durable(links, "delta-links"), "from_a", "from_b"), "delta-merged")
    moved = merged.where("node != cluster").select("node", F.col("cluster").alias("parent"))

    # Cards: of the clusters that are new, have grown or have met.
    here = arrivals.join(start.select(F.col("node").alias("group_id"), "cluster"), "group_id", "left").select(
        "notice_id", F.coalesce("cluster", "group_id").alias("was")
    ).join(merged.select(F.col("node").alias("was"), "cluster"), "was", "left").select("notice_id", F.coalesce("cluster", "was").alias("cluster_id"))
    grown = here.groupBy("cluster_id").agg(F.min("notice_id").alias("first_notice"))
    parts = merged.select(F.col("node").alias("part"), F.col("cluster").alias("cluster_id")).unionByName(
        grown.select(F.col("cluster_id").alias("part"), "cluster_id")
    ).distinct()
    held = store.lookup("cards", batch, parts.select(F.col("part").alias("cluster_id"))).withColumnRenamed("cluster_id", "part")
    # A cluster's card has a row for each night that touched it; the newest holds.
    held = held.groupBy("part", "card_id", "canonical_notice_id", "created_at").agg(F.max("updated_at").alias("updated_at"))
    claims = durable(held.join(parts, "part"), "delta-claims")
    order = F.struct("created_at", "canonical_notice_id", "card_id")
    oldest = claims.groupBy("cluster_id").agg(F.min(order).alias("card"))
    now = F.lit(as_of).cast("timestamp_ntz")
    touched = parts.select("cluster_id").distinct().join(grown, "cluster_id", "left").join(oldest, "cluster_id", "left")
    cards = durable(touched.select(
        "cluster_id", F.coalesce("card.card_id", F.concat(F.lit("CARD-"), F.col("first_notice").cast("string"))).alias("card_id"),
        F.coalesce("card.canonical_notice_id", "first_notice").alias("canonical_notice_id"),
        F.coalesce("card.created_at", now).alias("created_at"), now.alias("updated_at"),
    ), "delta-cards")
    redirects = claims.join(oldest, "cluster_id").where("card_id != card.card_id").select(
        F.col("card_id").alias("deprecated_card_id"), F.col("card.card_id").alias("active_card_id"), now.alias("merged_at")
    ).distinct()

    store.write("notices", batch, arrivals)
    store.write("contents", batch, placed.where("is_new"))
    store.write("bands", batch, own_bands)
    store.write("sets", batch, fresh)
    store.write("parents", batch, moved)
    store.write("redirects", batch, redirects)
    store.write("cards", batch, cards)


def run(stream: DataFrame, store: DeltaStore, checkpoint: str, percent: int, as_of: Callable[[int], str], **options) -> int:
    """Process the deltas that have arrived, one micro-batch each, and stop; returns the number of batches so far."""

    def each(batch: DataFrame, number: int) -> None:
        process_delta(replace(store, spark=batch.sparkSession), batch, number, percent, as_of(number), **options)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    last = query.lastProgress
    return 0 if last is None else last["batchId"] + 1


def cards_now(store: DeltaStore, batches: int) -> DataFrame:
    """``(notice_id, card_id)`` after so many batches: each notice over its group and the root of that."""
    roots = clusters.follow(store.read("parents", batches), "node", "parent")
    notices = store.read("notices", batches).join(roots.select(F.col("node").alias("group_id"), "cluster"), "group_id", "left")
    newest = store.read("cards", batches).groupBy("cluster_id").agg(F.max_by("card_id", "updated_at").alias("card_id"))
    return notices.select("notice_id", F.coalesce("cluster", "group_id").alias("cluster_id")).join(newest, "cluster_id").select("notice_id", "card_id")


def redirects_now(store: DeltaStore, batches: int) -> DataFrame:
    """``(deprecated_card_id, active_card_id)`` with chains of redirects followed to their end."""
    steps = store.read("redirects", batches)
    return clusters.follow(steps, "deprecated_card_id", "active_card_id").select(
        F.col("node").alias("deprecated_card_id"), F.col("cluster").alias("active_card_id")
    )
