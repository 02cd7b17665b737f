"""Catalogue of the incremental jobs, run over the given tables as files that arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.plans import notice_queries, retail_queries
from lakemart.plans import notices as N
from lakemart.sources import tables as T
from lakemart.streaming import index as I
from lakemart.streaming import keyed as K
from lakemart.streaming import lines as L
from lakemart.workspace import new_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


#: Numbers ascend in time, so a range of them is a range of days and a night's files touch few.
RANGE = 250_000


def _resent(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """A table as a stream of files in which every file is sent twice."""
    schema = T.table(spark, folder, name).schema
    first, again = (L.file_stream(spark, f"{folder}/{name}.parquet", schema, files_per_batch) for _ in range(2))
    return first.unionByName(again)


@query("SELECT event_id, min(ts) AS ts FROM events GROUP BY event_id")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive twice and in any order, merged into a table that holds the earliest of each."""
    events = _resent(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    events = events.withColumn("id_range", F.floor(F.col("event_id") / RANGE).cast("bigint"))
    path = new_path(spark, "stream-dedup")
    L.land_lines(events, f"{path}/table", f"{path}/progress", keys=["event_id"], order=["ts"], partition="id_range")
    return spark.read.schema(events.schema).parquet(f"{path}/table").select("event_id", "ts")


@query(retail_queries.ORACLES["revenue_by_month"])
def stream_revenue_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Lines sent twice, merged into a table as they arrive, then summed by month: the batch figures again."""
    lines = T.as_lines(_resent(spark, folder, "lineitem")).withColumn("bill_range", F.floor(F.col("bill_no") / RANGE).cast("bigint"))
    path = new_path(spark, "stream-lines")
    L.land_lines(
        lines, f"{path}/table", f"{path}/progress", keys=T.LINE_KEYS, order=T.LINE_ORDER, partition="bill_range"
    )
    landed = spark.read.schema(lines.schema).parquet(f"{path}/table")
    return retail_queries.by_month(T.with_revenue(landed))


@query(retail_queries.ORACLES["revenue_by_month"])
def stream_revenue_by_closed_days(spark: SparkSession, folder: str) -> DataFrame:
    """Lines sent twice, held until the day of their bill closes, then summed by month; a notice of a later day closes all.

    A bill's day is its order's, for the lines of one bill carry several; a bill without an order belongs to the first day.
    """
    path = new_path(spark, "stream-days")
    lines = T.as_lines(_resent(spark, folder, "lineitem"))
    orders = T.table(spark, folder, "orders")
    bills = orders.groupBy(F.col("o_orderkey").alias("bill_no")).agg(F.min("o_orderdate").cast("date").alias("bill_day"))
    first_day = F.lit("1992-01-01").cast("date")
    dated = lines.join(bills, "bill_no", "left").select(*lines.columns, F.coalesce("bill_day", first_day).alias("bill_day"), F.lit(False).alias("closing"))
    bills.agg(F.date_add(F.max("bill_day"), 60).alias("bill_day")).write.parquet(f"{path}/notices")
    notices = L.file_stream(spark, f"{path}/notices", "bill_day date").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in lines.schema], "bill_day", F.lit(True).alias("closing")
    )
    days = K.first_lines(dated.unionByName(notices), T.LINE_KEYS, T.LINE_ORDER, "bill_day", 30, lanes=1, closing="closing")
    K.run(days, path, f"{path}/progress")
    return retail_queries.by_month(T.with_revenue(K.read(spark, path, "lines", lines.schema)))


def _nightly(spark: SparkSession, folder: str) -> tuple[I.DeltaStore, int]:
    """Three nights of notices taken into an index, as files that arrive."""
    path = new_path(spark, "stream-cards")
    notices = T.table(spark, folder, "documents")
    deltas = notices.join(notice_queries.night_of(notices), "doc_id").select("doc_id", "text", "night")
    schema = notices.select("doc_id", "text").schema
    store, batches = I.DeltaStore(spark, f"{path}/store", ranges=16), 0  # each a file for each table and night
    for night in range(1, notice_queries.N_NIGHTS + 1):
        deltas.where(F.col("night") == night).drop("night").write.mode("append").parquet(f"{path}/inbox")
        stream = L.file_stream(spark, f"{path}/inbox", schema)
        batches = I.run(stream, store, f"{path}/progress", N.SIMILAR_PERCENT, lambda number: f"2024-01-{number + 1:02d} 00:00:00")
    return store, batches


@query(notice_queries.ORACLES["cards_after_rerun"])
def stream_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Three nightly deltas of notices; the cards equal those of three full re-runs."""
    store, batches = _nightly(spark, folder)
    return I.cards_now(store, batches).select(F.col("notice_id").alias("doc_id"), "card_id")
