"""Exact percentiles without gathering the values in one buffer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemart.workspace import durable


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, percents: Mapping[str, float], weight: Column | None = None
) -> DataFrame:
    """Per key: count, mean, minimum, maximum and the named percentiles (linear interpolation) of ``value``.

    Equal values are counted together before they move. Distinct values are dealt to ranges; a value's rank is what
    lies in the ranges before plus a running sum within its own, so no task holds all values of a key.
    """
    counted = df.groupBy(*keys, value).agg(F.sum(F.lit(1) if weight is None else weight).cast("bigint").alias("n"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = durable(durable(counted, "counted").repartitionByRange(ranges, *keys, value).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy(*keys, "_range").agg(F.sum("n").alias("_held"))
    ahead = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumns({"_before": F.coalesce(F.sum("_held").over(ahead), F.lit(0)), "total": F.sum("_held").over(W.partitionBy(*keys))})
    own = dealt.alias("d").join(sums.alias("s"), [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*keys, "_range")])
    own = own.select("d.*", "s._before", "s.total")
    ranked = own.withColumn("upto", F.col("_before") + F.sum("n").over(W.partitionBy(*keys, "_range").orderBy(value)))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") > rank, F.col(value)))

    wanted = []
    for name, p in percents.items():
        position = (F.col("total") - 1) * F.lit(p)
        wanted += [
            at(F.floor(position)).cast("double").alias(f"{name}_lo"), at(F.ceil(position)).cast("double").alias(f"{name}_hi"),
        ]
    summed = ranked.groupBy(*keys).agg(
        F.sum("n").alias("count"), F.sum(F.col(value) * F.col("n")).alias("sum"),
        F.min(value).alias("minimum"), F.max(value).alias("maximum"), *wanted,
    )
    between = [
        (F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo"))
         * ((F.col("count") - 1) * F.lit(p) - F.floor((F.col("count") - 1) * F.lit(p)))).alias(name)
        for name, p in percents.items()
    ]
    return summed.select(*keys, "count", "sum", "minimum", "maximum", *between)
