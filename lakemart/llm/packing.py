"""Concatenate and cut: documents as one stream of ids, cut into windows of one length.

Pass one tokenises each partition once and stores its ids with their offsets from the partition's start. Prefix sums
over the partitions' totals (one row a partition) turn those into offsets in the whole stream. Pass two cuts every
document at the window bounds; a document that crosses one gives a boundary record on either side. Nothing is shuffled
but the totals, and no task needs more than its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.textops import binary_column, by_bytes, encoder, release_memory
from lakemart.workspace import durable


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenised(docs: DataFrame, vocabulary: str, kind: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, part, before, n_ids, ids)``: each document's ids and ``end_id``, as unsigned little-endian integers of
    two bytes (four for a vocabulary beyond 65,536), and the ids before it in its partition. Null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before = encoder(vocabulary, kind), TaskContext.get().partitionId(), 0
        for batch in (small for batch in batches for small in by_bytes(batch, 1)):
            n = batch.num_rows
            ids, counts = coder.encode(batch.column(1))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, np.array(end_id, ids.dtype)) if n else ids
            counts = counts + 1
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(n, part, np.int32)), pa.array(starts), pa.array(counts), binary_column(ids, counts).cast(pa.binary())],
                ["doc_id", "part", "before", "n_ids", "ids"],
            )
        release_memory()

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, part int, before bigint, n_ids bigint, ids binary")


def with_offsets(stored: DataFrame) -> DataFrame:
    """Add ``at``, a document's first place in the stream of all ids.

    The joined side has one row for each input partition, which bounds what is broadcast.
    """
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("first"))
    return stored.join(F.broadcast(first), "part").withColumn("at", F.col("first") + F.col("before"))


def pack(
    docs: DataFrame, length: int = 2048, vocabulary: str | None = None, kind: str = "byte", end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``, a row for each piece.

    ``ids`` are the piece's ids as unsigned little-endian 32-bit integers. Every sequence but the last is full. Null
    and empty texts have the end id alone; a repeated row is packed as often as it occurs; a null doc_id stays null; an
    empty table gives no piece; other columns are ignored, whatever their names.
    """
    stored = durable(tokenised(docs, vocabulary or default_vocabulary(), kind, end_id, id_col, text_col), "token-ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (small for batch in batches for small in by_bytes(batch, 3)):
            at, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            windows = (at + n - 1) // length - at // length + 1
            row = np.repeat(np.arange(len(at)), windows)
            window = at[row] // length + np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            begin = np.maximum(at[row], window * length)
            size = np.minimum((at + n)[row], (window + 1) * length) - begin
            wide = [x for i, x in enumerate(batch.column(3)) for x in [np.frombuffer(x.as_py(), np.uint16 if len(x.as_py()) == 2 * n[i] else np.uint32)]]
            flat = np.concatenate(wide).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), *(pa.array(x) for x in (begin - at[row], size, n[row], window, begin - window * length)), binary_column(flat, size).cast(pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    schema = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    return with_offsets(stored).select("doc_id", "at", "n_ids", "ids").mapInArrow(cut, schema)
