"""The lake: partitioned landing, inventories and what pruning saves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.dedup import keep_first
from lakemart.sources import pos
from lakemart.workspace import durable

PARTITION_KEYS = ("year", "month", "store")


def with_month_keys(lines: DataFrame) -> DataFrame:
    return lines.select(
        "*", F.year("business_date").alias("year"), F.month("business_date").alias("month"),
        F.col("store_id").alias("store"),
    )


def land(df: DataFrame, path: str, keys: tuple[str, ...] = PARTITION_KEYS) -> None:
    """Write by partition; landing the same partitions again replaces them and leaves the others.

    The rebalance hint lets adaptive execution split a partition that is too large for one task and
    join small ones, so a store that holds a third of all lines is written by many tasks.
    """
    (
        df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path)
    )


def land_days(
    lines: DataFrame, path: str, partition: tuple[str, ...] = PARTITION_KEYS, keys: Sequence[str] = pos.LINE_KEYS,
    order: Sequence[str] = pos.LINE_ORDER,
) -> None:
    """Land one or more days, or re-sends of parts of them, and keep what their partitions already hold.

    The partitions that the new lines touch are read, joined with them, each line is kept once (the original before
    its re-sends), and those partitions are replaced.
    """
    spark, schema = lines.sparkSession, lines.schema
    spark.createDataFrame([], schema).write.mode("append").partitionBy(*partition).parquet(path)
    touched = lines.select(*partition).distinct()
    stored = spark.read.schema(schema).parquet(path).join(touched, list(partition), "left_semi").select(*schema.names)
    land(durable(keep_first(stored.unionByName(lines), keys, order), "landed-days"), path, partition)


def convert_notices(spark: SparkSession, source: str, target: str) -> None:
    """CSV part files to Parquet, one partition per part; parts that are there already are skipped."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    name = F.regexp_extract("path", r"([^/]+)\.csv$", 1)
    files = listing.option("pathGlobFilter", "*.csv").load(source).select("path", name.alias("part"))
    part = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    parts = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(source).withColumn("part", part)
    spark.createDataFrame([], parts.schema).write.mode("append").partitionBy("part").parquet(target)
    done = listing.option("pathGlobFilter", "*.parquet").load(target).select(F.regexp_extract("path", r"/part=([^/]+)/", 1).alias("part"))
    missing = [r["path"] for r in files.join(done.distinct(), "part", "left_anti").select("path").collect()]  # names of files only
    if missing:
        again = spark.read.schema(parts.drop("part").schema).option("header", True).option("multiLine", True).option("escape", '"')
        again.csv(missing).withColumn("part", part).write.mode("append").partitionBy("part").parquet(target)


def scan_counts(df: DataFrame, key: str, names: tuple[str, str] = ("row_count", "key_count")) -> DataFrame:
    return df.agg(F.count("*").alias(names[0]), F.countDistinct(key).alias(names[1]))


def object_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Number and total size of the objects below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("length").agg(
        F.count("*").alias("objects"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    )


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, in one plan."""
    counts = None
    for name, df in frames.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def catalog_counts(spark: SparkSession) -> DataFrame:
    """Row count of every table and view the session knows."""
    return table_counts({t.name: spark.table(t.name) for t in spark.catalog.listTables()})


def _files(df: DataFrame, layout: str) -> DataFrame:
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    return files.groupBy("path").agg(F.max("size").alias("size")).agg(
        F.lit(layout).alias("layout"), F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )


def pruning_report(everything: DataFrame, wanted: DataFrame) -> DataFrame:
    """Files and bytes a partition filter opens against the unfiltered layout, and the ratio.

    ``wanted`` filters ``everything`` on partition columns only.
    """
    both = _files(everything, "all files").unionByName(_files(wanted, "pruned"))
    flat = both.agg(
        F.max(F.when(F.col("layout") == "all files", F.col("files"))).alias("all_files"),
        F.max(F.when(F.col("layout") == "all files", F.col("bytes"))).alias("all_bytes"),
        F.max(F.when(F.col("layout") == "pruned", F.col("files"))).alias("pruned_files"),
        F.max(F.when(F.col("layout") == "pruned", F.col("bytes"))).alias("pruned_bytes"),
    )
    return flat.select(
        "*",
        (F.col("all_files") / F.greatest("pruned_files", F.lit(1))).alias("file_ratio"),
        (F.col("all_bytes") / F.greatest("pruned_bytes", F.lit(1))).alias("byte_ratio"),
    )


def write_bands(bands: DataFrame, path: str, files: int = 64) -> None:
    """Band rows by band, each file holding one range of buckets: a bucket lookup opens one file.

    Ranges are cut by sampled quantiles of the rows, so a hot bucket takes a range of its own.
    """
    (
        bands.repartitionByRange(files, "band_id", "bucket_hash").sortWithinPartitions("band_id", "bucket_hash")
        .write.mode("overwrite").partitionBy("band_id").parquet(path)
    )


def lookup(bands: DataFrame, band_id: int, bucket_hash: int, exclude: int | None = None) -> DataFrame:
    """Notices in one bucket, without the asking one."""
    found = bands.where((F.col("band_id") == band_id) & (F.col("bucket_hash") == bucket_hash))
    return found if exclude is None else found.where(F.col("doc_id") != exclude)


def lookup_report(bands: DataFrame, bucket) -> DataFrame:
    """The same lookup on both layouts: rows found, files that hold them and their size."""
    from lakemart.workspace import new_path

    spark = bands.sparkSession
    ordered, plain = new_path(spark, "bands-ordered"), new_path(spark, "bands-plain")
    write_bands(bands, ordered)
    bands.write.parquet(plain)
    reports = None
    for layout, path in (("by bucket", ordered), ("unordered", plain)):
        rows = lookup(spark.read.parquet(path), bucket["band_id"], bucket["bucket_hash"])
        touched = rows.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
            F.count("*").alias("n"), F.max("file_size").alias("size")
        )
        report = touched.agg(
            F.lit(layout).alias("layout"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_found"),
            F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        )
        reports = report if reports is None else reports.unionByName(report)
    return reports
