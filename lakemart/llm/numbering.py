"""Places of rows inside their groups, whatever share of the rows one group has.

Rows are ranged by group and order, so a large group lies in several partitions. Each partition numbers its own rows in
one pass; a group that was begun in an earlier partition gets the totals of those partitions added.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.workspace import durable


def numbered(df: DataFrame, group: str, order: Sequence[str], weight: str | None = None) -> DataFrame:
    """``df`` with ``place``, a row's number in its group from 0, and with ``weight`` (long, not null) also ``before``,
    the weights ahead of it in the group.

    ``group`` must not be null. Nulls in ``order`` come first. Rows equal in all of ``order`` are told apart by where they
    were read, so copies of one row do not end in one partition. The joined side has at most two rows for each partition.
    """
    columns = df.columns
    ranged = df.withColumn("_nth", F.monotonically_increasing_id())
    keys = [group, *order, "_nth"]
    sorted_rows = ranged.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*columns)
    at_group = columns.index(group)
    at_weight = columns.index(weight) if weight else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, opened, place, before = TaskContext.get().partitionId(), None, True, 0, 0
        seen = False
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = batch.column(at_group)
            fresh = np.empty(n, bool)
            fresh[0] = not seen or values[0].as_py() != last
            fresh[1:] = pc.not_equal(values.slice(1), values.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            runs = np.cumsum(fresh)
            starts = np.concatenate([[0], np.flatnonzero(fresh)])
            weights = batch.column(at_weight).to_numpy() if weight else np.zeros(n, np.int64)
            total = np.concatenate([[0], np.cumsum(weights)])
            local = np.arange(n) - starts[runs] + np.where(runs == 0, place, 0)
            ahead = total[:-1] - total[starts[runs]] + np.where(runs == 0, before, 0)
            head = (runs == (1 if not seen else 0)) & opened
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(local), pa.array(ahead), pa.array(head), pa.array(np.full(n, part, np.int32))],
                [*columns, "place", "before", "_head", "_part"],
            )
            opened = bool(head[-1])
            place, before = int(local[-1]) + 1, int(ahead[-1] + weights[-1])
            seen, last = True, values[n - 1].as_py()

    schema = T.StructType([
        *sorted_rows.schema.fields, T.StructField("place", T.LongType()), T.StructField("before", T.LongType()),
        T.StructField("_head", T.BooleanType()), T.StructField("_part", T.IntegerType()),
    ])
    stored = durable(sorted_rows.mapInArrow(run, schema), "numbered")
    opening = stored.where("_head").select(group).distinct()
    spans = stored.join(F.broadcast(opening), group, "left_semi").groupBy(group, "_part").agg(
        F.count("*").alias("n"), (F.sum(weight) if weight else F.lit(0)).cast("bigint").alias("w")
    )
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = spans.select(
        group, "_part", F.sum("n").over(earlier).alias("_n"), F.sum("w").over(earlier).alias("_w")
    ).where("_n is not null")
    placed = stored.join(F.broadcast(ahead), [group, "_part"], "left")

    def shifted(local: str, more: str):
        return (F.col(local) + F.when(F.col("_head"), F.coalesce(more, F.lit(0))).otherwise(F.lit(0))).alias(local)

    extra = [shifted("place", "_n")] + ([shifted("before", "_w")] if weight else [])
    return placed.select(*columns, *extra)
