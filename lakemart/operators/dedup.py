"""Keep-first de-duplication, the proof that it is idempotent, and missing store-days."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemart.workspace import durable


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``, which has to be a total order of differing rows.

    Spark limits each group to one row before the shuffle as well as after it, so a key that holds a
    large part of all rows sends one row per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def dedup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raw, kept and removed rows of a keep-first on ``keys``, without doing it."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"), F.count("*").alias("kept_rows")
    )
    return totals.withColumn("removed_rows", F.col("raw_rows") - F.col("kept_rows"))


def row_digest(columns: Sequence[Column | str]) -> Column:
    """SHA-256 of a row; a NULL differs from an empty text."""
    parts = [
        F.coalesce(F.concat(F.lit("="), (F.col(c) if isinstance(c, str) else c).cast("string")), F.lit("-"))
        for c in columns
    ]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def dataset_checksum(df: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    """Row count and content checksum that do not depend on row order.

    Four 60-bit slices of every row digest are added up, so partial sums combine on the map side and no
    sort and no single-task concatenation is needed. Batches of digests are added up as machine integers.
    """
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, (_, ends, data) = batch.num_rows, batch.column(0).buffers()
            if not n:
                continue
            first = np.frombuffer(ends, np.int32)[batch.column(0).offset]
            words = np.frombuffer(data, ">u8", 4 * n, int(first)).astype(np.uint64).reshape(n, 4)
            slices = words >> np.array([4, 8, 12, 16], np.uint64)
            slices[:, 1:] |= (words[:, :3] << np.array([56, 52, 48], np.uint64)) & np.uint64((1 << 60) - 1)
            sums = [(slices >> np.uint64(30)).sum(0), (slices & np.uint64((1 << 30) - 1)).sum(0)]
            yield pa.RecordBatch.from_pydict({"n": [n], **{f"{half}_{i}": [int(s[i])] for half, s in zip(("high", "low"), sums) for i in range(4)}})

    parts = ", ".join(f"{half}_{i} bigint" for half in ("high", "low") for i in range(4))
    digest = df.select(F.unhex(row_digest(columns)).alias("d")).mapInArrow(add_up, f"n bigint, {parts}")
    total = lambda c: F.sum(F.col(c).cast("decimal(28,0)"))
    slices = [(total(f"high_{i}") * F.lit(1 << 30) + total(f"low_{i}")).cast("decimal(38,0)").cast("string").alias(f"slice_{i}") for i in range(4)]
    sums = digest.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), *slices)
    names = [f"slice_{i}" for i in range(4)]
    return sums.select("row_count", *names, F.sha2(F.concat_ws("|", *names), 256).alias("checksum"))


def idempotency_report(runs: Sequence[DataFrame], keys: Sequence[str], columns: Sequence[Column | str],
                       order: Sequence[Column | str]) -> DataFrame:
    """One row per load: raw, kept and removed rows and the checksum of the kept ones."""
    report = None
    for number, raw in enumerate(runs, start=1):
        counts = dedup_counts(raw, keys).withColumn("run", F.lit(number))
        check = dataset_checksum(keep_first(raw, keys, order), columns).select(
            F.lit(number).alias("run"), "row_count", "checksum"
        )
        row = counts.join(check, "run")
        report = row if report is None else report.unionByName(row)
    return report


def merge_first(stored: DataFrame, raw: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``stored``, which has one row per key, after ``raw`` is merged into it: ``keep_first`` over both.

    Only rows that come before what is stored, or have a new key, are sorted and written; the files of ``stored`` stay.
    """
    def named(prefix: str) -> list[Column]:
        return [F.col(k).alias(prefix + k) for k in keys]

    def same(prefix: str) -> list[Column]:
        return [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys]

    held = stored.select(*named("_held_"), F.struct(*order).alias("_held"))
    earlier = raw.join(held, same("_held_"), "left").where(F.col("_held").isNull() | (F.struct(*order) < F.col("_held")))
    changes = durable(keep_first(earlier.select(*raw.columns), keys, order), "changes")
    return stored.join(changes.select(*named("_new_")), same("_new_"), "left_anti").unionByName(changes)


def repeated_loads(raw: DataFrame, keys: Sequence[str], columns: Sequence[Column | str], order: Sequence[str],
                   runs: int = 3) -> DataFrame:
    """Load the same rows again and again into one table, each time merged with what it holds; one row per load with
    the rows it brought, the rows the table holds after it, and the table's checksum as read back."""
    stored, report = None, None
    for number in range(1, runs + 1):
        stored = durable(keep_first(raw, keys, order), "loaded") if stored is None else merge_first(stored, raw, keys, order)
        row = dataset_checksum(stored, columns).select(F.lit(number).alias("run"), F.col("row_count").alias("kept_rows"), "checksum")
        report = row if report is None else report.unionByName(row)
    brought = raw.agg(F.count("*").alias("raw_rows"))
    report = report.withColumn("_one", F.lit(1)).join(brought.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return report.select("run", "raw_rows", "kept_rows", (F.col("raw_rows") - F.col("kept_rows")).alias("removed_rows"), "checksum")


def is_idempotent(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("runs"),
        ((F.countDistinct("kept_rows") == 1) & (F.countDistinct("checksum") == 1)).alias("idempotent"),
    )


def without_voided_bills(lines: DataFrame) -> DataFrame:
    """Drop every line of a bill that has a VOID line; lines without bill stay."""
    voided = F.max((F.col("line_type") == "VOID").cast("int")).over(W.partitionBy("bill_no"))
    return lines.withColumn("_voided", voided).where(F.col("bill_no").isNull() | (F.coalesce("_voided", F.lit(0)) == 0)).drop("_voided")


def missing_store_days(lines: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Runs of days without any line, per store, between two dates (both inclusive; from the lines where not given).

    Gaps are read off neighbouring observed days, so the store x day calendar is never built. A store
    that appears in ``lines`` only outside the period misses all of it.
    """
    if first_day is None or last_day is None:
        ends = lines.agg(F.min("business_date").alias("first"), F.max("business_date").alias("last")).first()
        first_day, last_day = first_day or ends["first"], last_day or ends["last"]
    first, last = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    inside = F.col("business_date").between(first, last)
    days = lines.select("store_id", F.when(inside, F.col("business_date")).alias("day")).distinct()
    by_store = W.partitionBy("store_id").orderBy(F.col("day").asc_nulls_last())
    seen = days.select(
        "store_id", "day",
        F.lag("day").over(by_store).alias("before"),
        F.lead("day").over(by_store).alias("after"),
    )
    # The run before each observed day; the last observed day (or none at all) also opens the closing run.
    leading = F.struct(
        F.coalesce(F.date_add("before", 1), first).alias("first_missing"),
        F.date_sub(F.coalesce("day", F.date_add(last, 1)), 1).alias("last_missing"),
    )
    closing = F.struct(
        F.date_add("day", 1).alias("first_missing"), F.lit(last).alias("last_missing")
    )
    is_last = F.col("day").isNotNull() & F.col("after").isNull()
    placeholder = F.col("day").isNull() & F.col("before").isNotNull()
    runs = seen.where(~placeholder).select(
        "store_id",
        F.explode(F.when(is_last, F.array(leading, closing)).otherwise(F.array(leading))).alias("gap"),
    )
    n_days = F.datediff("gap.last_missing", "gap.first_missing") + 1
    return runs.where(n_days > 0).select(
        "store_id", "gap.first_missing", "gap.last_missing", n_days.alias("n_days")
    )


def store_day_gaps(gaps: DataFrame) -> DataFrame:
    """Missing days per store."""
    return gaps.groupBy("store_id").agg(
        F.sum("n_days").alias("n_missing"), F.min("first_missing").alias("first_missing")
    )
