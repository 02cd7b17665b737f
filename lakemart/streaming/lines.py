"""Lines that arrive in files over days, re-sends among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators.dedup import keep_first
from lakemart.workspace import durable


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files at ``path``: a folder of part files, a single file, or a pattern of either."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def dedup_within(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First arrival of each key. State for a key is kept for ``delay`` of event time, which has to cover the
    longest time after which a line may be sent or may arrive: what is older than that is dropped. Where no such
    time is known, ``land_lines`` merges without one."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what has arrived to a table and stop."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def land_lines(
    stream: DataFrame, target: str, checkpoint: str, *, keys: Sequence[str], order: Sequence[str], partition: str,
) -> None:
    """Merge arriving lines into a table partitioned by ``partition``, whenever they come.

    Each micro-batch reads the partitions it touches, keeps the first row per key of old and new together and
    replaces those partitions, so a replayed batch or a re-send of any age changes nothing. ``keys`` must
    determine ``partition`` (a bill belongs to one business day).
    """

    schema = stream.schema
    stream.sparkSession.createDataFrame([], schema).write.mode("append").partitionBy(partition).parquet(target)

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            touched = batch.select(partition).distinct()
            stored = spark.read.schema(schema).parquet(target).join(touched, partition, "left_semi")
            merged = durable(keep_first(stored.select(*schema.names).unionByName(batch), keys, order), "merged-lines")
            (
                merged.hint("rebalance", partition).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(target)
            )
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
