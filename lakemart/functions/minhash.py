"""MinHash signatures and LSH bands."""

from __future__ import annotations

import sys
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions.scalars import hex_to_long
from lakemart.functions.sets import parities, spans

# Signature length, bands x rows, and the Mersenne prime below which all values stay.
# Shingle hash and coefficients have 31 bits, so products fit in 62 and a signature value in an int.
SIGNATURE_SIZE = 128
BANDS, ROWS = 16, 8
BAND_CONFIGS = ((32, 4), (16, 8), (8, 16))
PRIME = 2**31 - 1
SEED = 42


def coefficients(size: int = SIGNATURE_SIZE, seed: int = SEED) -> list[tuple[int, int]]:
    """The multipliers and offsets of the hash family, the same in every run."""
    draw = np.random.RandomState(seed)
    a = draw.randint(1, PRIME, size=size, dtype=np.int64)
    b = draw.randint(0, PRIME, size=size, dtype=np.int64)
    return [(int(x), int(y)) for x, y in zip(a, b)]


def shingle_hash(shingle: Column) -> Column:
    """31-bit hash of a shingle: the head of its SHA-256."""
    return hex_to_long(F.sha2(shingle, 256), 1, 8) % F.lit(PRIME)


def shingle_hashes(shingles: Column) -> Column:
    return F.transform(shingles, shingle_hash)


_BLOCK = 1 << 16

# The Arrow function below travels with its helpers, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _minima(hashes: np.ndarray, starts: np.ndarray, coefs: list[tuple[int, int]]) -> np.ndarray:
    out = np.empty((len(starts), len(coefs)), dtype=np.int32)
    for k, (a, b) in enumerate(coefs):
        # Modulo 2^31-1 without a division: high and low bits added, and the lesser of that and of it less the prime, which wraps if below.
        mixed = hashes * np.uint64(a) + np.uint64(b)
        mixed = (mixed & np.uint64(PRIME)) + (mixed >> np.uint64(31))
        out[:, k] = np.minimum.reduceat(np.minimum(mixed, mixed - np.uint64(PRIME)), starts)
    return out


def signatures(hashes: pa.ListArray, coefs: list[tuple[int, int]]) -> np.ndarray:
    """Row-wise minima of the hash family over a batch; an empty set is all zeros.

    Rows are taken in blocks of about 64k values, so scratch memory follows the longest row, not the batch.
    """
    offsets = hashes.offsets.to_numpy().astype(np.int64)
    values = hashes.values.to_numpy(zero_copy_only=False).astype(np.uint64)
    out = np.zeros((len(hashes), len(coefs)), dtype=np.int32)
    filled = np.flatnonzero(np.diff(offsets) > 0)
    at = 0
    while at < len(filled):
        limit = offsets[filled[at]] + _BLOCK
        to = max(at + 1, int(np.searchsorted(offsets[filled + 1], limit, side="right")))
        rows = filled[at:to]
        first, last = offsets[rows[0]], offsets[rows[-1] + 1]
        out[rows] = _minima(values[first:last], offsets[rows] - first, coefs)
        at = to
    return out


def signature(hashes: Column, size: int = SIGNATURE_SIZE, seed: int = SEED) -> Column:
    """MinHash signature of an array of shingle hashes, ``array<int>`` of ``size`` values (4 bytes each)."""
    coefs = coefficients(size, seed)

    @F.arrow_udf("array<int>")
    def minhash(batch: pa.Array) -> pa.Array:
        flat = signatures(batch, coefs).reshape(-1)
        ends = np.arange(0, len(flat) + 1, len(coefs), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return minhash(hashes)


def sketch_rows(texts: pa.Array, k: int, coefs: list[tuple[int, int]]) -> pa.StructArray:
    """``(shingles, content_key, parity, signature, bands)`` of texts of words with one blank between them; a shingle is named by 64
    bits of its SHA-256, of which the first 32 are its ``shingle_hash``, and ``bands`` are ``band_hashes``."""
    found = []
    for text in texts.cast(pa.binary()).to_pylist():
        named = np.frombuffer(b"".join([sha256(x).digest() for x in spans(text or b"", k)]), ">u8")[::4]
        found.append(np.sort(named.astype(np.uint64).view(np.int64)))
    values = np.concatenate([np.empty(0, np.int64), *found])
    ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
    hashes = (values.view(np.uint64) >> np.uint64(32)) % np.uint64(PRIME)
    signed = signatures(pa.ListArray.from_arrays(ends, pa.array(hashes)), coefs)
    heads = [sha256(",".join(map(str, part)).encode()).hexdigest()[:15] for row in signed.tolist() for part in _cut(row)]
    bands = np.fromiter((int(head, 16) for head in heads), np.int64, len(heads)).reshape(-1, BANDS)

    def rows(table: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]), pa.array(table.reshape(-1)))

    sets = pa.ListArray.from_arrays(ends, pa.array(values))
    keys = pa.array([sha256(x.tobytes()).hexdigest() for x in found], pa.string())
    return pa.StructArray.from_arrays([sets, keys, parities(sets), rows(signed), rows(bands)], ["shingles", "content_key", "parity", "signature", "bands"])


def _cut(row: list[int]) -> list[list[int]]:
    return [row[i * ROWS : (i + 1) * ROWS] for i in range(BANDS)]


def sketched(words: Column, k: int, size: int = SIGNATURE_SIZE, seed: int = SEED) -> Column:
    """``sketch_rows`` of an array of words without blanks: shingles of ``k`` words as sorted 64-bit values, the SHA-256 of these, their
    parities, MinHash signature and bands; a text of fewer words is the set of its words. Each shingle is hashed once."""
    coefs = coefficients(size, seed)

    @F.arrow_udf("shingles array<bigint>, content_key string, parity binary, signature array<int>, bands array<bigint>")
    def rows(texts: pa.Array) -> pa.Array:
        return sketch_rows(texts, k, coefs)

    return rows(F.array_join(words, " "))


def estimated_jaccard(a: Column, b: Column) -> Column:
    """Share of equal positions."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x)
    return equal / F.size(a)


def band_hashes(sig: Column, bands: int = BANDS, rows: int = ROWS) -> Column:
    """One bucket hash per band: 60 bits of the SHA-256 of its slice of the signature."""
    return F.array(*[
        hex_to_long(F.sha2(F.array_join(F.slice(sig, i * rows + 1, rows).cast("array<string>"), ","), 256), 1, 15)
        for i in range(bands)
    ])


def shares_bucket(bands_a: Column, bands_b: Column) -> Column:
    return F.exists(F.zip_with(bands_a, bands_b, lambda x, y: x == y), lambda same: same)


def shares_band(sig_a: Column, sig_b: Column, bands: int, rows: int) -> Column:
    """Whether two signatures agree on all rows of some band, for any bands x rows split."""
    hit = F.lit(False)
    for i in range(bands):
        hit = hit | (F.slice(sig_a, i * rows + 1, rows) == F.slice(sig_b, i * rows + 1, rows))
    return hit


def survival_probability(similarity: Column, bands: int, rows: int) -> Column:
    """Chance that a pair of this similarity shares a bucket."""
    return F.lit(1.0) - F.pow(F.lit(1.0) - F.pow(similarity, F.lit(rows)), F.lit(bands))


def survival_threshold(bands: int, rows: int) -> float:
    """Similarity around which the survival curve is steepest."""
    return (1.0 / bands) ** (1.0 / rows)
