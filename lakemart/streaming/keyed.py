"""Till lines kept in state until their day closes.

A business day, dealt to a few lanes, holds its lines in keyed state: the best row of each line so far, whichever file came first.
When the newest day seen is ``delay`` past it, a timer closes the day and its lines go out, each once. Lines that arrive
for a closed day are not lost: they go to a side table, for a reload of that day. State and timers are those of Spark, so a
restart continues where it was and a replayed batch writes its own files again.

Lines travel and wait as Arrow tables in a binary column, one for each day and lane of a run of rows. State is kept in RocksDB, on the
executors' disks: the default store would hold all open days in their heaps.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Spark drops what is older than its watermark, so the watermark trails by this much and days close by timers ahead of it: lines
#: up to this late are reported.
HORIZON_DAYS = 3650
DAY_MS = 86_400_000

#: Bytes of lines that a task gathers before it deals them out by day; rows that wait for a merge; rows in a batch of lines; packed
#: lines in a batch on their way to the shuffle.
RUN_BYTES = 16 << 20
MERGE_ROWS = 100_000
BATCH_ROWS = 10_000
DEALT_ROWS = 256

#: Where and how a new query keeps its state, unless the session says otherwise; a checkpoint keeps the store that it began with. A
#: commit writes files, so that lines do not stay in native memory; what all stores of an executor hold there is bounded.
STATE = "spark.sql.streaming.stateStore"
SETTINGS = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "false",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.maxMemoryUsageMB": "100",
    f"{STATE}.rocksdb.writeBufferSizeMB": "4",
    f"{STATE}.rocksdb.allowFAllocate": "false",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def _packed(lines: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, lines.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(lines, max_chunksize=BATCH_ROWS)
    return sink.getvalue()


def _unpacked(raw: bytes) -> pa.Table:
    with pa.ipc.open_stream(raw) as held:
        return held.read_all()


def _best(lines: pa.Table, keys: Sequence[str], order: Sequence[str]) -> pa.Table:
    """The first row by ``order`` (nulls first) of each key; null keys are equal."""
    lines = lines.combine_chunks()
    lines = lines.take(pc.sort_indices(lines, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"))
    ranked = lines.select(list(keys)).append_column("_rank", pa.array(np.arange(len(lines))))
    return lines.take(ranked.group_by(list(keys), use_threads=False).aggregate([("_rank", "min")])["_rank_min"].sort())


def _folded(rows: pa.Table) -> pa.Table:
    """Equal rows as one, their number added up in ``_copies``; rows with nested values stay as they are."""
    names = [c for c in rows.column_names if c != "_copies"]
    if any(pa.types.is_nested(rows.schema.field(c).type) for c in names):
        return rows
    found = rows.combine_chunks().group_by(names, use_threads=False).aggregate([("_copies", "sum")])
    return found.rename_columns([*names, "_copies"])


def first_lines(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], day: str, delay_days: int, lanes: int = 4, closing: str | None = None,
) -> DataFrame:
    """The stream's lines with ``late``: false for the first row by ``order`` (nulls first) of each key, when its day has closed;
    true, at once, for each line of a closed day.

    ``keys`` must determine ``day`` (a date column); lines without a day are late. ``lanes`` split a day that is a large part of
    all lines, by a hash of the keys. ``closing`` is a boolean column: such rows carry no line, they only say how far time
    has come (a till's end-of-month notice, say), and never go out.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [c for c in stream.columns if c != closing]
    line_schema = T.StructType([stream.schema[c] for c in names])
    arrow = to_arrow_schema(line_schema)
    sent = arrow.append(pa.field("_copies", pa.int64()))
    out = T.StructType([*line_schema.fields, T.StructField("late", T.BooleanType())])
    dealt_schema = T.StructType().add("_day", stream.schema[day].dataType).add("_lane", "long").add("_lines", "binary")
    dealt_arrow = to_arrow_schema(dealt_schema)
    keys, order = list(keys), list(order)

    def dealt(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """A row for each day and lane of the run with its lines, and one without lines for each that a closing row names."""
        days = rows["_day"].combine_chunks().dictionary_encode(null_encoding="encode").indices
        groups = np.stack([rows["_closing"].to_numpy(), days.to_numpy(), rows["_lane"].to_numpy()])
        by = np.lexsort(groups[::-1])
        groups, rows = groups[:, by], rows.take(pa.array(by)).combine_chunks()
        starts = np.flatnonzero(np.append(True, (groups[:, 1:] != groups[:, :-1]).any(axis=0)))
        (lines,) = rows.select([*names, "_copies"]).cast(sent).to_batches()
        sizes = np.diff(starts, append=len(rows))
        for some in np.array_split(np.arange(len(starts)), -(-len(starts) // DEALT_ROWS)):
            (heads,) = rows.take(pa.array(starts[some])).combine_chunks().to_batches()
            packed = [
                None if mark else lines.slice(at, n).serialize().to_pybytes()
                for mark, at, n in zip(heads["_closing"].to_pylist(), starts[some].tolist(), sizes[some].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([heads["_day"], heads["_lane"], pa.array(packed, pa.binary())], schema=dealt_arrow)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Both sends of a line often meet here. They go on as one row with their number, for each of them may be late."""
        run, size = [], 0
        for batch in filter(len, batches):
            run.append(batch.append_column("_copies", pa.repeat(pa.scalar(1, pa.int64()), len(batch))))
            size += batch.nbytes
            if size >= RUN_BYTES:
                folded = _folded(pa.Table.from_batches(run))
                run, size = folded.to_batches(), folded.nbytes
                if size >= RUN_BYTES // 2:
                    yield from dealt(folded)
                    run, size = [], 0
                del folded
                pa.default_memory_pool().release_unused()
        if run:
            yield from dealt(_folded(pa.Table.from_batches(run)))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (closed,) = state.get
            state.remove()
            yield pd.DataFrame({"_lines": [closed], "late": [False]})
            return
        closes = (0 if key[0] is None else (pd.Timestamp(key[0]) - pd.Timestamp(0)).days * DAY_MS) + (delay_days - HORIZON_DAYS) * DAY_MS
        open_day = key[0] is not None and closes > state.getCurrentWatermarkMs()
        held = [_unpacked(state.get[0])] if state.exists else []
        merged = sum(map(len, held))
        new = 0
        for frame in frames:
            packed = frame["_lines"].dropna()
            if not open_day:
                yield pd.DataFrame({"_lines": packed, "late": True})
                continue
            for raw in packed:
                held.append(pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(raw), sent)]).select(names))
                new += len(held[-1])
                if new >= max(MERGE_ROWS, merged):
                    held = [_best(pa.concat_tables(held), keys, order)]
                    merged, new = len(held[0]), 0
        if open_day and held:
            state.update((_packed(_best(pa.concat_tables(held), keys, order)),))
            state.setTimeoutTimestamp(closes)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, late in zip(batch["_lines"], batch["late"].to_pylist(), strict=True):
                if late:
                    lines = pa.ipc.read_record_batch(raw.as_buffer(), sent)
                    lines = pa.Table.from_batches([lines.take(pa.array(np.repeat(np.arange(len(lines)), lines["_copies"])))]).select(names)
                else:
                    lines = _unpacked(raw.as_buffer())
                yield from lines.append_column("late", pa.repeat(late, len(lines))).to_batches(max_chunksize=BATCH_ROWS)

    marked = stream.withColumn("_closing", F.coalesce(closing, F.lit(False)) if closing else F.lit(False))
    marked = marked.select(*names, "_closing", F.col(day).alias("_day"), F.pmod(F.xxhash64(*keys), F.lit(lanes)).alias("_lane"))
    packed = marked.mapInArrow(deal, dealt_schema)
    at = F.coalesce(F.col("_day").cast("timestamp"), F.lit("2000-01-01").cast("timestamp"))
    timed = packed.withColumn("_at", at).withWatermark("_at", f"{HORIZON_DAYS} days")
    days = timed.groupBy("_day", "_lane").applyInPandasWithState(
        step, "_lines binary, late boolean", "lines binary", "append", GroupStateTimeout.EventTimeTimeout
    )
    return days.mapInArrow(unpack, out)


def run(lines: DataFrame, path: str, checkpoint: str) -> None:
    """Take what has arrived, write closed days to ``path/lines`` and late lines to ``path/late``, and stop. Open days wait in
    state for the next run."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            for table, late in (("lines", False), ("late", True)):
                part = batch.where(F.col("late") == late).drop("late")
                part.write.mode("overwrite").parquet(f"{path}/{table}/batch={number}")
        finally:
            batch.unpersist()

    conf = lines.sparkSession.conf
    unset = {k: v for k, v in SETTINGS.items() if conf.get(k, None) is None}
    try:
        for k, v in unset.items():
            conf.set(k, v)
        query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:  # the query has its own copy
        for k in unset:
            conf.unset(k)
    query.awaitTermination()


def read(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """``lines`` or ``late`` as written so far."""
    return spark.read.schema(schema).parquet(f"{path}/{table}").select(*schema.names)
