"""Entity cards whose ids survive nightly re-clustering."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemart.operators.clusters import follow
from lakemart.workspace import durable

# The columns of the three card tables.
CARDS_SCHEMA = "card_id string, canonical_notice_id bigint, created_at timestamp_ntz, updated_at timestamp_ntz"
MAPPING_SCHEMA = "notice_id bigint, card_id string"
REDIRECTS_SCHEMA = "deprecated_card_id string, active_card_id string, merged_at timestamp_ntz"


@dataclass(frozen=True)
class CardState:
    cards: DataFrame
    mapping: DataFrame
    redirects: DataFrame

    def durable(self) -> CardState:
        return CardState(
            durable(self.cards, "cards"), durable(self.mapping, "card-mapping"), durable(self.redirects, "card-redirects")
        )


def empty_state(spark: SparkSession) -> CardState:
    return CardState(
        spark.createDataFrame([], CARDS_SCHEMA), spark.createDataFrame([], MAPPING_SCHEMA),
        spark.createDataFrame([], REDIRECTS_SCHEMA),
    )


def update_cards(state: CardState, clusters: DataFrame, as_of: str) -> CardState:
    """The state after a run that found ``clusters(notice_id, cluster_id)``.

    * A cluster with notices of one card keeps that card and its new notices join it.
    * A cluster with notices of several cards keeps the oldest; the others redirect to it, and older redirects
      follow.
    * When a card's notices fall into several clusters, the card stays with its canonical notice (or, if that
      is gone, with the smallest cluster); the other parts get new cards.
    * A cluster without a card gets ``CARD-<smallest notice>``; an id that was ever used before gets the date
      appended, so that no bookmark changes its meaning.
    * Notices and cards this run did not see stay as they are.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    placed = durable(
        clusters.join(state.mapping, "notice_id", "left").select("notice_id", "cluster_id", "card_id"), "card-placed"
    )

    # Who claims which card: cluster x card, with the claim of the canonical notice first.
    claims = (
        placed.where(F.col("card_id").isNotNull())
        .join(state.cards.select("card_id", "canonical_notice_id", "created_at"), "card_id")
        .groupBy("card_id", "cluster_id", "created_at", "canonical_notice_id")
        .agg(F.max((F.col("notice_id") == F.col("canonical_notice_id")).cast("int")).alias("holds_canonical"))
    )
    holder = F.row_number().over(W.partitionBy("card_id").orderBy(F.col("holds_canonical").desc(), "cluster_id"))
    owned = durable(
        claims.withColumn("_rank", holder).where(F.col("_rank") == 1).drop("_rank", "holds_canonical"), "card-owned"
    )
    oldest = owned.groupBy("cluster_id").agg(
        F.min_by("card_id", F.struct("created_at", "canonical_notice_id", "card_id")).alias("survivor")
    )

    used = state.cards.select("card_id").unionByName(
        state.redirects.select(F.col("deprecated_card_id").alias("card_id"))
    ).distinct()
    # Dated ids are counted on: CARD-n-yyyymmdd, then -2, -3 and so on, whichever of them still exist.
    stem = F.regexp_replace("card_id", r"(-\d{8})-\d+$", "$1")
    dated = used.where(F.col("card_id").rlike(r"-\d{8}(-\d+)?$")).groupBy(stem.alias("dated_id")).agg(F.count("*").alias("issued"))
    first = placed.groupBy("cluster_id").agg(F.min("notice_id").alias("first_notice"))
    fresh = durable(
        first.join(oldest, "cluster_id", "left_anti")
        .withColumn("card_id", F.concat(F.lit("CARD-"), F.col("first_notice").cast("string")))
        .join(used.withColumn("taken", F.lit(True)), "card_id", "left")
        .withColumn("dated_id", F.concat_ws("-", "card_id", F.date_format(now, "yyyyMMdd")))
        .join(dated, "dated_id", "left")
        .withColumn("next_id", F.when(F.col("issued").isNull(), F.col("dated_id")).otherwise(
            F.concat_ws("-", "dated_id", (F.col("issued") + 1).cast("string"))
        ))
        .withColumn("card_id", F.when(F.col("taken"), F.col("next_id")).otherwise(F.col("card_id")))
        .select("cluster_id", "card_id", "first_notice"), "card-fresh"
    )
    card_of = oldest.withColumnRenamed("survivor", "card_id").unionByName(fresh.select("cluster_id", "card_id"))

    mapped = placed.drop("card_id").join(card_of, "cluster_id").select("notice_id", "card_id")
    merged = owned.join(oldest, "cluster_id").where(F.col("card_id") != F.col("survivor")).select(
        F.col("card_id").alias("deprecated_card_id"), F.col("survivor").alias("active_card_id"), now.alias("merged_at")
    )
    moved = merged.select(F.col("deprecated_card_id").alias("card_id"), F.col("active_card_id").alias("moved_to"))
    redirects = (
        state.redirects.withColumnRenamed("active_card_id", "card_id").join(moved, "card_id", "left")
        .select("deprecated_card_id", F.coalesce("moved_to", "card_id").alias("active_card_id"), "merged_at")
        .unionByName(merged)
    )
    unseen = (
        state.mapping.join(placed, "notice_id", "left_anti").join(moved, "card_id", "left")
        .select("notice_id", F.coalesce("moved_to", "card_id").alias("card_id"))
    )
    grown = placed.where(F.col("card_id").isNull()).join(card_of.withColumnRenamed("card_id", "grown_card"), "cluster_id")
    touched = grown.select(F.col("grown_card").alias("card_id")).unionByName(
        merged.select(F.col("active_card_id").alias("card_id"))
    ).distinct().withColumn("touched", F.lit(True))
    cards = (
        state.cards.join(moved.select("card_id"), "card_id", "left_anti").join(touched, "card_id", "left")
        .select(
            "card_id", "canonical_notice_id", "created_at",
            F.when(F.col("touched"), now).otherwise(F.col("updated_at")).alias("updated_at"),
        )
        .unionByName(fresh.select(
            "card_id", F.col("first_notice").alias("canonical_notice_id"), now.alias("created_at"), now.alias("updated_at")
        ))
    )
    return CardState(cards, mapped.unionByName(unseen), redirects)


def resolve(state: CardState, bookmarks: DataFrame) -> DataFrame:
    """Where bookmarked ``card_id``s lead today: active card, canonical notice and members. Chains of redirects, as several runs
    leave them, are followed to their end."""
    ends = follow(state.redirects, "deprecated_card_id", "active_card_id")
    followed = bookmarks.join(
        ends.select(F.col("node").alias("card_id"), F.col("cluster").alias("active_card_id")), "card_id", "left"
    ).select("card_id", F.coalesce("active_card_id", "card_id").alias("active_card_id"))
    sizes = state.mapping.groupBy(F.col("card_id").alias("active_card_id")).agg(F.count("*").alias("members"))
    active = state.cards.select(F.col("card_id").alias("active_card_id"), "canonical_notice_id")
    return followed.join(active, "active_card_id", "left").join(sizes, "active_card_id", "left").select(
        "card_id", "active_card_id", "canonical_notice_id", F.coalesce("members", F.lit(0)).alias("members")
    )


def stability(issued: DataFrame, state: CardState) -> DataFrame:
    """Of all ``(card_id, notice_id)`` ever handed out: cards, how many still resolve, and how many lost a notice.

    A notice is lost when its card leads to a card that no longer holds it; only a split can do that.
    """
    led = issued.join(
        resolve(state, issued.select("card_id").distinct()).select("card_id", "active_card_id", "canonical_notice_id"),
        "card_id",
    ).join(state.mapping.withColumnRenamed("card_id", "card_now"), "notice_id", "left")
    per_card = led.groupBy("card_id").agg(
        F.max(F.col("canonical_notice_id").isNull().cast("int")).alias("broken"),
        F.max((~F.col("card_now").eqNullSafe(F.col("active_card_id"))).cast("int")).alias("lost"),
    )
    return per_card.agg(
        F.count("*").alias("issued"), F.count_if(F.col("broken") == 0).alias("resolved"),
        F.coalesce(F.sum("broken"), F.lit(0)).alias("broken"), F.coalesce(F.sum("lost"), F.lit(0)).alias("lost_notices"),
    )
