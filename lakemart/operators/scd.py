"""Point-in-time joins against slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def intervals_from_starts(revisions: DataFrame, key: str, start: str, end: str = "valid_until") -> DataFrame:
    """Half-open validity from start dates alone: each row ends where the next one of its key begins."""
    following = F.lead(start).over(W.partitionBy(key).orderBy(start))
    return revisions.withColumn(end, F.coalesce(following, F.lit(OPEN_END).cast("date")))


def as_of_join(
    facts: DataFrame,
    dim: DataFrame,
    *,
    on: str,
    date_col: str,
    start: str,
    end: str,
    how: str = "left",
    end_inclusive: bool = True,
    spread: int = 64,
) -> DataFrame:
    """Join the version of ``dim`` that was valid on ``date_col``; a NULL end means still valid.

    The key equality keeps this a hash or merge join with the dates as a residual condition; which side
    is broadcast is left to Catalyst, which knows the sizes. Facts without a key match nothing, so in an
    outer join they are spread over ``spread`` join partitions instead of meeting in one.
    """
    last = F.coalesce(F.col(f"d.{end}"), F.lit(OPEN_END).cast("date"))
    day = F.col(f"f.{date_col}")
    before_end = day <= last if end_inclusive else day < last
    matches = (F.col(f"f.{on}") == F.col(f"d.{on}")) & (day >= F.col(f"d.{start}")) & before_end
    fact_cols = [F.col(f"f.{c}") for c in facts.columns]
    dim_cols = [F.col(f"d.{c}") for c in dim.columns if c not in facts.columns]
    if how == "inner":
        kept = facts.where(F.col(on).isNotNull()).alias("f")
        return kept.join(dim.alias("d"), matches).select(*fact_cols, *dim_cols)
    lane = F.when(F.col(on).isNull(), F.pmod(F.xxhash64(*facts.columns), F.lit(spread))).otherwise(F.lit(0))
    left = facts.withColumn("_lane", lane.cast("bigint")).alias("f")
    right = dim.withColumn("_lane", F.lit(0).cast("bigint")).alias("d")
    return left.join(right, matches & (F.col("f._lane") == F.col("d._lane")), how).select(*fact_cols, *dim_cols)


def carry_forward(
    facts: DataFrame, revisions: DataFrame, *, on: str, date_col: str, start: str, end: str | None = None, days: int = 30,
) -> DataFrame:
    """``facts`` with the columns of the last revision of their key that began on or before their date; a left join.

    Facts and revisions are merged by date and the last revision seen is carried on. Each key is cut into ranges of ``days``
    days; a range opens with the revision in force at its first day, known from the revisions alone. So a key that holds half of
    all facts is as many sorts as it has ranges, and no fact is compared with more than one revision. Of revisions of one key
    and start the last in the order of their other columns counts. With ``end`` (inclusive, null: open) a revision is in force until then,
    and an earlier one does not come back. Facts without key or date get nulls and take no part in the merge. Columns of
    ``revisions`` that ``facts`` has are left out; names that begin with two underscores are reserved.
    """
    values = [c for c in revisions.columns if c not in facts.columns]
    if end is not None and end not in values:
        raise ValueError(f"facts have a column {end} of their own")
    range_of = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days).cast("int")
    usable = F.col(on).isNotNull() & F.col(date_col).isNotNull()
    span = facts.where(usable).agg(F.min(date_col).alias("__from"), F.max(date_col).alias("__to"))
    held = revisions.where(F.col(on).isNotNull() & F.col(start).isNotNull()).select(
        F.col(on).alias("__key"), F.col(start).alias("__day"), F.struct(*values).alias("__value")
    )
    held = held.groupBy("__key", "__day").agg(F.max("__value").alias("__value"))
    following = F.lead("__day").over(W.partitionBy("__key").orderBy("__day"))
    held = held.withColumn("__next", following).join(F.broadcast(span))
    opening = F.greatest(range_of(F.col("__day")) + 1, range_of(F.col("__from")))
    closing = range_of(F.least(F.coalesce("__next", "__to"), "__to"))
    opened = held.where(opening <= closing).select("__key", F.explode(F.sequence(opening, closing)).alias("__range"), F.lit(None).cast("date").alias("__day"), "__value")
    begun = held.select("__key", range_of(F.col("__day")).alias("__range"), "__day", "__value")
    known = opened.unionByName(begun).withColumn("__fact", F.lit(None).cast(facts.schema))
    merged = facts.where(usable).select(
        F.col(on).alias("__key"), range_of(F.col(date_col)).alias("__range"), F.col(date_col).alias("__day"),
        F.lit(None).cast(held.schema["__value"].dataType).alias("__value"), F.struct(*facts.columns).alias("__fact"),
    ).unionByName(known)
    order = W.partitionBy("__key", "__range").orderBy(F.col("__day").asc_nulls_first(), F.col("__fact").isNotNull())
    merged = merged.withColumn("__value", F.last("__value", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    valid = F.lit(True) if end is None else F.col(f"__value.{end}").isNull() | (F.col("__day") <= F.col(f"__value.{end}"))
    found = merged.where(F.col("__fact").isNotNull()).select("__fact.*", F.when(valid, F.col("__value")).alias("__value"))
    found = found.select(*facts.columns, *(F.col(f"__value.{c}").alias(c) for c in values))
    bare = facts.where(~usable).select(*facts.columns, *(F.lit(None).cast(revisions.schema[c].dataType).alias(c) for c in values))
    return found.unionByName(bare)


def daily_rollup(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines added up per product, day and further keys.

    Point-in-time attributes depend on product and day only, so reports that need sums join this
    instead of the lines: a product that is on every bill still has one row per day.
    """
    return lines.groupBy(*keys).agg(
        F.count("*").alias("lines"),
        F.sum("qty").alias("qty"),
        F.sum("unit_price").alias("price_sum"),
        F.sum("revenue").alias("revenue"),
    )
