"""Columns of 64-bit sets in Arrow: parity sketches, which bound how far two sets differ, and prefixes in one order of all values."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The Arrow functions below travel with their helpers, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Values are counted by their low bits, in this many cells: 8 MB of counts, however many values there are.
CELLS = 1 << 21


def _parts(sets: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows and each row's number of them."""
    sizes = np.diff(sets.offsets.to_numpy().astype(np.int64))
    return sets.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False), sizes


def parities(sets: pa.Array) -> pa.Array:
    """For each set a bit field, at least as wide as the set is large and a power of two: whether an odd number of its values fall on a bit."""
    values, sizes = _parts(sets)
    widths = 1 << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64)
    ends = np.cumsum(widths)
    at = np.repeat(ends - widths, sizes) + (values & (np.repeat(widths, sizes) - 1))
    odd = (np.bincount(at, minlength=int(ends[-1]) if len(ends) else 0) & 1).astype(bool)
    bounds = np.concatenate([[0], ends // 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(np.packbits(odd, bitorder="little"))])


def distance(a: bytes, b: bytes) -> int:
    """Bits in which two fields differ, the wider one folded to the width of the other: at most the values that only one set has."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    if len(a) < len(b):
        a, b, x, y = b, a, y, x
    bits = 8 * len(a)
    while bits > 8 * len(b):
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    return (x ^ y).bit_count()


def spans(text: bytes, k: int) -> set[bytes]:
    """The shingles of ``k`` words of a text with one blank between words; of fewer words, the words."""
    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    if not text or len(blanks) + 1 < k:
        return set(text.split(b" ")) if text else set()
    starts, ends = [0, *(blanks + 1).tolist()], [*blanks.tolist(), len(text)]
    return {text[a:b] for a, b in zip(starts, ends[k - 1 :])}


def letter_runs(text: str, k: int) -> int:
    """How many different runs of ``k`` letters a text has; a shorter text is one run. Seven bits a letter hold ASCII, up to nine letters."""
    n = len(text) - k + 1
    if n < 1:
        return 1
    if not text.isascii() or k > 9:
        return len({text[i : i + k] for i in range(n)})
    data, packed = np.frombuffer(text.encode(), np.uint8), np.zeros(n, np.uint64)
    for i in range(k):
        packed = (packed << np.uint64(7)) | data[i : i + n]
    packed.sort()
    return 1 + int(np.count_nonzero(packed[1:] != packed[:-1]))


def distinct_spans(words: Column, k: int) -> Column:
    """How many shingles of ``k`` words an array of words without blanks has."""
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(spans(t, k)) for t in texts.cast(pa.binary()).to_pylist()], pa.int32())

    return F.arrow_udf("int")(count)(F.array_join(words, " "))


def distinct_letter_runs(text: Column, k: int) -> Column:
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([letter_runs(t, k) for t in texts.to_pylist()], pa.int32())

    return F.arrow_udf("int")(count)(text)


def jaccards(a: Column, b: Column, ks: tuple[int, ...]) -> Column:
    """Jaccard of the shingles of each of some lengths, of two texts with one blank between words; 0 for two empty texts."""
    def one(x: bytes, y: bytes, k: int) -> float:
        p, q = spans(x, k), spans(y, k)
        shared = len(p & q)
        return shared / (len(p) + len(q) - shared) if p or q else 0.0

    def measure(left: pa.Array, right: pa.Array) -> pa.Array:
        both = zip(left.cast(pa.binary()).to_pylist(), right.cast(pa.binary()).to_pylist())
        return pa.array([[one(x, y, k) for k in ks] for x, y in both], pa.list_(pa.float64()))

    return F.arrow_udf("array<double>")(measure)(a, b)


def may_reach(a: Column, b: Column, total: Column, percent: int) -> Column:
    """Whether sets with these parities and this sum of sizes can have a Jaccard of ``percent``."""
    def check(left: pa.Array, right: pa.Array, sizes: pa.Array) -> pa.Array:
        apart = np.fromiter(map(distance, left.to_pylist(), right.to_pylist()), np.int64, len(left))
        return pa.array(apart * (100 + percent) <= sizes.to_numpy(zero_copy_only=False) * (100 - percent))

    return F.arrow_udf("boolean")(check)(a, b, total)


def prefixes(counts: np.ndarray, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over ``(group_id, shingles)``: ``(shingle, group_id, n, before, short)``, the first ``n - ceil(t n) + 1`` values of
    each set by the counts of their cells; ``short`` are those that suffice where the other set is not smaller."""
    names = ["shingle", "group_id", "n", "before", "short"]

    def cut(group_ids: pa.Array, sets: pa.ListArray) -> pa.RecordBatch:
        values, sizes = _parts(sets)
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((values, counts[values & (len(counts) - 1)], row))
        before = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        n = sizes[row]
        kept = before < n - (n * percent + 99) // 100 + 1
        row, n, before, values = row[kept], n[kept], before[kept], values[order][kept]
        short = before < n - (2 * percent * n + 99 + percent) // (100 + percent) + 1
        return pa.RecordBatch.from_arrays([pa.array(values), group_ids.take(pa.array(row)), pa.array(n), pa.array(before), pa.array(short)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield cut(part.column(0), part.column(1))

    return run
