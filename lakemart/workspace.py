"""Where intermediate tables live.

A lineage cut must outlive any executor, so it is a written table in the shared folder that the cluster
names in ``spark.checkpoint.dir``. Only a local session that names none gets a folder of its own.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables; fails on a cluster that does not name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="lakemart-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/lakemart/{label}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Delete the intermediate tables of this library in the session's shared folder, once results have been consumed.

    Sessions that run at the same time should not share a folder.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/lakemart")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for row in spark.sql("SHOW TABLES LIKE 'lakemart_*'").collect():
        if re.fullmatch(r"lakemart_\w+_[0-9a-f]{32}", row.tableName) and not row.isTemporary:
            where = spark.sql(f"DESCRIBE TABLE EXTENDED {row.tableName}").where("col_name = 'Location'").first()
            if where and f"{shared_dir(spark)}/lakemart/" in where.data_type:
                spark.sql(f"DROP TABLE {row.tableName}")


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the files: one computation, no lineage behind it."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def durable_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """``durable``, laid out in buckets of ``key``: joins and grouping by it do not move the rows of the table again.

    The buckets are as many as the session's shuffles have partitions. The catalogue knows the table by its folder's name.
    """
    spark = df.sparkSession
    n, path = int(spark.conf.get("spark.sql.shuffle.partitions")), new_path(spark, label)
    name = "lakemart_" + path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(n, key).write.bucketBy(n, key).option("path", path).saveAsTable(name, format="parquet")
    return spark.table(name)


def durable_observed(df: DataFrame, label: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """``durable`` with named aggregates of the rows, taken while they are written."""
    seen = Observation()
    table = durable(df.observe(seen, *metrics), label)
    return table, seen.get


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a scan that has fewer splits than the session has cores over all of them.

    A large scan has enough splits and is left alone: nothing is shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)
