"""Token ids in files, compressed by an adaptive context-mixing range coder.

A file is a Parquet folder of frames. A frame holds whole documents in order: their ids, the number of ids of each, and all
ids cut into blocks of ``BLOCK``. A block starts from a fresh model and a fresh coder and carries the CRC-32 of its ids, so it
decodes alone and damage is found in it.

The model. Order 2 and order 1 each foretell one id, from the last two ids or the last one, with a confidence that hits raise
and misses halve. One decision says whether order 2 is right, else whether order 1 is, or neither; the probability of the first
mixes, in the logistic domain and with weights that learn, what both orders' confidences have meant so far. If neither
is right, order 0 gives the id by how often the block has had it so far, counted anew at the places of ``_COUNTED``; an id that
the last count does not know is given by its number of binary digits, with the frequencies of those of known ids, and its
digits. Verdict and symbol are one step of a 64-bit range coder. All of it comes from integers and exact or correctly rounded
arithmetic, so every machine decodes alike. The blocks of a frame advance together, one array element each, which
is what makes this affordable in numpy: short blocks make many lanes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.packing import with_offsets
from lakemart.llm.textops import by_bytes, encoder, release_memory

BLOCK = 2048
LANES = 6144
_GROUPS, _FIRSTS, _SECONDS = 7, 2, 12  # 2^7 groups of 4 guesses of order 1 and 12 of order 2, a cache line each
_GUESSES = 16 << _GROUPS
_CHANCES = 16 + 32 + 32
_SLOTS = 4096
_COUNTED = (0, 16, 40, 80, 160, 320, 576, 960, 1408)
_TRUST = np.stack([np.arange(16) >> 1, np.minimum(np.arange(16) + 1, 15)], 1).astype(np.int32).ravel() << 16
_LENGTHS = 17
_LENGTH = np.frexp(np.arange(1 << 16))[1].astype(np.int32)  # an id's number of binary digits
_TAIL = np.maximum(np.arange(_LENGTHS) - 1, 0).astype(np.int32)  # and how many of them its length leaves open
_FLOOR = np.where(np.arange(_LENGTHS) > 0, 1 << _TAIL, 0).astype(np.int32)
_GROUP = 64


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """The logistic function and its inverse on a grid of 4096."""
    x = np.arange(-2047, 2048)
    squash = np.clip(np.rint(4096 / (1 + np.exp(-x / 256))), 1, 4095).astype(np.int32)
    p = np.arange(4096) + 0.5
    stretch = np.clip(np.rint(256 * np.log(p / (4096 - p))), -2047, 2047).astype(np.int32)
    return squash, stretch


_SQUASH, _STRETCH = _steps()
_WORD, _FULL = np.uint64(32), np.uint64(0xFFFFFFFF)
_VERDICT, _STEP = 18, np.uint64(30)


class _Model:
    """The orders 1 and 2 of each lane."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes)
        self.guesses = np.zeros(lanes * _GUESSES, np.int32)  # an id and, above 16 bits, the trust in it
        self.chances = np.full(lanes * _CHANCES, 2048, np.int32)
        self.weights = np.full((2, lanes), 32768, np.int32)
        self.last, self.before = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.own_guesses = lane * _GUESSES
        self.own_chances = lane * _CHANCES + np.array([[0], [16], [48]])

    def foretell(self, n: int) -> tuple[np.ndarray, ...]:
        """For the first ``n`` lanes: the ids that order 1 and order 2 foretell, and the bounds, of 2^18, below which order 2
        is right and below which order 1 is."""
        spread = self.last[:n] * 40503
        near = self.own_guesses[:n] + ((spread >> 1) & ((16 << _GROUPS) - 16))
        self.at = np.empty((2, n), np.int64)
        np.add(near, (spread >> 3) & ((1 << _FIRSTS) - 1), out=self.at[0])
        spread += self.before[:n] * 30011
        np.add(near, (1 << _FIRSTS) + (((spread >> 3) & 0x3FFF) * _SECONDS >> 14), out=self.at[1])
        self.held = self.guesses.take(self.at)
        ids, trust = self.held & 0xFFFF, self.held >> 16
        slot = np.empty((3, n), np.int32)
        slot[0] = trust[1]
        np.add(trust[0] << 1, ids[0] == ids[1], out=slot[1])
        slot[2] = slot[1]
        self.where = self.own_chances[:, :n] + slot
        self.chance = self.chances.take(self.where)
        self.stretched = _STRETCH.take(self.chance[:2])
        mixed = self.weights[:, :n] * self.stretched
        mixed = (mixed[0] + mixed[1]) >> 16
        self.p = _SQUASH.take(np.minimum(np.maximum(mixed, -2047), 2047) + 2047)
        second = np.minimum(self.chance[2], 4031)
        low = self.p << 6
        return ids[0], ids[1], low, low + ((4096 - self.p) * second >> 6) + 1

    def learn(self, hit1: np.ndarray, hit2: np.ndarray, now: np.ndarray) -> None:
        """``hit1`` tells whether order 1 was right, whatever order 2 said."""
        n = len(now)
        wanted = hit2 * np.int32(4095)
        self.weights[:, :n] += (self.stretched * ((wanted - self.p) * 6)) >> 14
        moved = self.chance
        moved[:2] += (wanted - moved[:2]) >> 5
        moved[2] += ((hit1 * np.int32(4095) - moved[2]) >> 5) * ~hit2
        self.chances[self.where] = moved
        trust = self.held >> 16 << 1
        trust[0] += hit1
        trust[1] += hit2
        self.guesses[self.at] = _TRUST.take(trust) + now
        self.before[:n] = self.last[:n]
        self.last[:n] = now


class _Counts:
    """Order 0: 4096 slots dealt to the ids of each row of ``seen`` and to the lengths of ids that are new.

    A row's entries are its ids, ascending, then the lengths, then an end; an entry holds the symbol (a length above all
    ids) and, above 17 bits, its first slot.
    """

    def __init__(self, seen: np.ndarray):
        rows, n = seen.shape
        ids, first = np.zeros((rows, n + 1), np.uint16), np.ones((rows, n + 1), bool)
        ids[:, :n] = seen
        ids[:, :n].sort(axis=1, kind="stable")
        np.not_equal(ids[:, 1:n], ids[:, : n - 1], out=first[:, 1:n])
        known = np.count_nonzero(first, axis=1)  # and the end
        at = first.ravel().nonzero()[0]
        self.ids, self.distinct, self.ends = ids.ravel().take(at), known - 1, np.cumsum(known)
        self.base = self.ends - known + _LENGTHS * np.arange(rows)
        free = (_SLOTS - _LENGTHS - self.distinct) / (2 * n + _LENGTHS)
        self.row = np.repeat(np.arange(rows), known)
        self.rank = np.arange(len(at)) - np.repeat(self.ends - known, known)
        self.place = np.arange(len(at)) + self.row * _LENGTHS
        ahead = 2 * (at - self.row * (n + 1)) - self.rank
        lengths = np.bincount(self.row * _LENGTHS + _LENGTH.take(self.ids), minlength=rows * _LENGTHS).reshape(rows, _LENGTHS)
        lengths[:, 0] -= 1
        after = (2 * n - self.distinct)[:, None] + np.cumsum(lengths + 1, axis=1)
        ranks = self.distinct[:, None] + np.arange(1, _LENGTHS + 1)
        tail = self.base[:, None] + ranks
        self.entries = np.empty(len(at) + _LENGTHS * rows, np.int32)
        self.entries[self.place] = ((self.rank + (ahead * free.take(self.row)).astype(np.int64)) << 17) + self.ids
        self.entries[tail] = (ranks + (after * free[:, None]).astype(np.int64) << 17) + ((1 << 16) + 1 + np.arange(_LENGTHS))
        self.entries[self.base + self.distinct] += 1 << 16
        self.entries[tail[:, -1]] = _SLOTS << 17

    def slots(self) -> np.ndarray:
        """The rank of the entry that holds each slot of each row."""
        size = self.distinct + (_LENGTHS + 1)
        rank = np.arange(len(self.entries), dtype=np.int32) - np.repeat(self.base.astype(np.int32), size)
        return np.repeat(rank.astype(np.uint16), np.maximum(np.diff(self.entries >> 17, append=0), 0))

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """The first slot and the number of slots of each of a row's ids, and the length, plus 1, of those that are new."""
        place, rank_of = np.empty(wanted.shape, np.int64), np.zeros(_GROUP << 16, np.uint16)
        known = self.distinct + 1
        for a in range(0, len(wanted), _GROUP):
            ids = wanted[a : a + _GROUP]
            own = slice(self.ends[a] - known[a], self.ends[a + len(ids) - 1])
            row, rank = self.row[own], self.rank[own]
            inner = rank < self.distinct.take(row)
            key = ((row - a << 16) + self.ids[own])[inner]
            rank_of[key] = rank[inner] + 1
            place[a : a + _GROUP] = rank_of.take((np.arange(len(ids)) << 16)[:, None] + ids)
            rank_of[key] = 0
        new = place == 0
        length = _LENGTH.take(wanted)
        place += self.base[:, None] - 1
        np.copyto(place, (self.base + self.distinct)[:, None] + length, where=new)
        first = self.entries.take(place) >> 17
        return first, (self.entries.take(place + 1) >> 17) - first, ((length + 1) * new).astype(np.uint8)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The coded words of each block of 16-bit ids; blocks come longest first."""
    lanes, model = len(blocks), _Model(len(blocks))
    sizes = np.array([len(b) for b in blocks])
    most = int(sizes.max(initial=0))
    live = np.searchsorted(-sizes, -np.arange(most), "left").tolist()
    ids = np.zeros((lanes, most), np.uint16)
    for k, b in enumerate(blocks):
        ids[k, : len(b)] = b
    lane, low, span, at = np.arange(lanes), np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64), np.zeros(lanes, np.int64)
    out = np.zeros((lanes, most // 3 + 256), np.uint64)

    def put(lane: np.ndarray, l: np.ndarray, r: np.ndarray, start: np.ndarray, size: np.ndarray | int, bits: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray]:
        r = r >> bits
        moved = l + r * start.astype(np.uint64)
        if not isinstance(size, int):
            r *= size.astype(np.uint64)
        over = (moved < l).nonzero()[0]
        if len(over):
            k = lane[over]
            out[k, at[k] - 1] += np.uint64(1)
        short = (r <= _FULL).nonzero()[0]
        if len(short):
            k, full = lane[short], moved[short]
            out[k, at[k]] = full >> _WORD
            at[k] += 1
            moved[short] = full << _WORD
            r[short] <<= _WORD
        return moved, r

    for since, until in zip(_COUNTED, (*_COUNTED[1:], max(most, _COUNTED[-1]))):
        if since >= most:
            break
        n = live[since]
        coming = ids[:n, since:until]
        firsts, widths, lengths = (np.ascontiguousarray(x.T) for x in _Counts(ids[:n, :since]).find(coming))
        coming = np.ascontiguousarray(coming.T)
        for t in range(len(coming)):
            n = live[since + t]
            now = coming[t, :n].astype(np.int32)
            if t % 64 == 0 and int(at.max()) + 64 * 2 > out.shape[1]:
                out = np.concatenate([out, np.zeros_like(out)], 1)
            g1, g2, below2, below1 = model.foretell(n)
            hit1, hit2 = now == g1, now == g2
            hit = hit1 | hit2
            rest = (1 << _VERDICT) - below1
            start, size = (below1 << 12) + rest * firsts[t, :n], rest * widths[t, :n]
            k = hit.nonzero()[0]
            two, bound = hit2[k], below2[k]
            start[k], size[k] = np.where(two, 0, bound << 12), np.where(two, bound, below1[k] - bound) << 12
            low[:n], span[:n] = put(lane, low[:n], span[:n], start, size, _STEP)
            length = lengths[t, :n] * ~hit
            k = length.nonzero()[0]
            if len(k):
                length = length[k].astype(np.int64) - 1
                low[k], span[k] = put(k, low[k], span[k], now[k] - _FLOOR.take(length), 1, _TAIL.take(length).astype(np.uint64))
            model.learn(hit1, hit2, now)
    words = []
    for k in range(lanes):
        own = np.append(out[k, : at[k]], [low[k] >> _WORD, low[k] & _FULL])
        over = own >> _WORD
        while over.any():
            own &= _FULL
            own[:-1] += over[1:]
            over = own >> _WORD
        words.append(own.astype("<u4").tobytes())
    return words


def decode_blocks(words: list[bytes], sizes: np.ndarray) -> list[np.ndarray]:
    """The ids of each block; blocks come longest first."""
    lanes, model = len(words), _Model(len(words))
    most = max(map(len, words), default=0) // 4 + 64
    code = np.zeros((lanes, most), np.uint32)
    for k, w in enumerate(words):
        code[k, : len(w) // 4] = np.frombuffer(w, "<u4")
    flat, home = code.ravel(), np.arange(lanes) * most
    value, span, at = (code[:, 0].astype(np.uint64) << _WORD) | code[:, 1], np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64), np.full(lanes, 2, np.int64)
    longest = int(sizes.max(initial=0))
    live = np.searchsorted(-sizes, -np.arange(longest), "left").tolist()
    ids = np.zeros((longest, lanes), np.uint16)

    def take(lane: np.ndarray, v: np.ndarray, r: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        v = v - r * start.astype(np.uint64)
        if not isinstance(size, int):
            r = r * size.astype(np.uint64)
        short = (r <= _FULL).nonzero()[0]
        if len(short):
            k = lane[short]
            v[short] = (v[short] << _WORD) | flat[home[k] + np.minimum(at[k], most - 1)]
            at[k] += 1
            r[short] <<= _WORD
        return v, r

    lane = np.arange(lanes)
    for since, until in zip(_COUNTED, (*_COUNTED[1:], max(longest, _COUNTED[-1]))):
        if since >= longest:
            break
        n = live[since]
        counts = _Counts(np.ascontiguousarray(ids[:since, :n].T))
        slots, own_slots, base, entries = counts.slots(), lane[:n] * _SLOTS, counts.base, counts.entries
        for t in range(since, min(until, longest)):
            n = live[t]
            g1, g2, below2, below1 = model.foretell(n)
            r = span[:n] >> _STEP
            place = np.minimum(value[:n] // r, np.uint64((1 << 30) - 1)).astype(np.int32)
            edge, rest = below1 << 12, (1 << _VERDICT) - below1
            slot = ((place - edge) / rest).astype(np.int32) & (_SLOTS - 1)  # exact below 2^53
            entry = base[:n] + slots.take(own_slots[:n] + slot)
            found = entries.take(entry)
            first, now = found >> 17, found & 0x1FFFF
            start, size = edge + rest * first, rest * ((entries.take(entry + 1) >> 17) - first)
            k = (place < edge).nonzero()[0]
            bound = below2[k]
            two = place[k] < bound << 12
            now[k], start[k], size[k] = np.where(two, g2[k], g1[k]), np.where(two, 0, bound << 12), np.where(two, bound, below1[k] - bound) << 12
            value[:n], span[:n] = take(lane, value[:n], r, start, size)
            k = (now >> 16).nonzero()[0]
            if len(k):
                length = now[k] & 0xFFFF
                tail, v = _TAIL.take(length).astype(np.uint64), value[k]
                r = span[k] >> tail
                open_digits = np.minimum(v // r, (np.uint64(1) << tail) - np.uint64(1)).astype(np.int32)
                value[k], span[k] = take(k, v, r, open_digits, 1)
                now[k] = _FLOOR.take(length) + open_digits
            model.learn(now == g1, now == g2, now)
            ids[t, :n] = now
    ids = np.ascontiguousarray(ids.T)
    return [ids[k, :s] for k, s in enumerate(sizes.tolist())]


def _frame(ids: np.ndarray) -> tuple[list[bytes], list[int]]:
    blocks = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
    coded = [x for i in range(0, len(blocks), LANES) for x in encode_blocks(blocks[i : i + LANES])]
    return coded, [zlib.crc32(b.astype("<u4").tobytes()) for b in blocks]


def read_frame(coded: list[bytes], checks: list[int], n: int) -> np.ndarray:
    """The ids of a frame; raises ValueError when a block's checksum differs."""
    sizes = np.minimum(BLOCK, n - BLOCK * np.arange(len(coded)))
    blocks = [b for i in range(0, len(coded), LANES) for b in decode_blocks(coded[i : i + LANES], sizes[i : i + LANES])]
    for k, (block, check) in enumerate(zip(blocks, checks)):
        if zlib.crc32(block.astype("<u4").tobytes()) != check:
            raise ValueError(f"block {k}: checksum differs")
    return np.concatenate(blocks) if blocks else np.empty(0, np.uint16)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_ids(
    docs: DataFrame, path: str, vocabulary: str | None = None, kind: str = "word", end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of all texts, each followed by ``end_id``, as files at ``path`` in ascending id order.

    Null and empty texts have the end id alone; rows of one id are written one after the other, null ids first; an empty
    table gives a folder without frames. The vocabulary has at most 65,536 ids. Other columns are ignored.
    """
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before, held, ids, docs_in, counts_in = encoder(vocabulary, kind), TaskContext.get().partitionId(), 0, 0, [], [], []

        def frame() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            coded, checks = _frame(flat)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(flat)], pa.int64()), pa.array([docs_in], pa.list_(pa.int64())),
                 pa.array([counts_in], pa.list_(pa.int64())), pa.array([coded], pa.list_(pa.binary())), pa.array([checks], pa.list_(pa.int64()))],
                ["part", "before", "n_ids", "doc_ids", "counts", "blocks", "checks"],
            )

        for batch in (small for batch in batches for small in by_bytes(batch, 1)):
            flat, counts = coder.encode(batch.column(1))
            if flat.dtype != np.uint16:
                raise ValueError("ids of more than 16 bits")
            flat, counts = np.insert(flat, np.cumsum(counts), np.uint16(end_id)), counts + 1
            ends, at = np.cumsum(counts), 0
            while at < len(counts):
                begin = int(ends[at] - counts[at])
                to = min(max(at + 1, int(np.searchsorted(ends, begin + BLOCK * LANES - held, "right"))), len(counts))
                if held and int(ends[to - 1]) - begin + held > BLOCK * LANES:
                    yield frame()
                    before, held, ids, docs_in, counts_in = before + held, 0, [], [], []
                    continue
                ids.append(flat[begin : int(ends[to - 1])])
                docs_in += batch.column(0).slice(at, to - at).to_pylist()
                counts_in += counts[at:to].tolist()
                held += len(ids[-1])
                at = to
        if held:
            yield frame()
        release_memory()

    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = max(source.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    ordered = source.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    schema = "part int, before bigint, n_ids bigint, doc_ids array<bigint>, counts array<bigint>, blocks array<binary>, checks array<bigint>"
    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of each written document; ``ids`` are unsigned little-endian 32-bit integers."""
    frames = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, n, docs_in, counts, blocks, checks = (batch.column(k)[i].as_py() for k in range(6))
                flat, counts = read_frame(blocks, checks, n).astype("<u4"), np.array(counts, np.int64)
                ends = np.cumsum(counts)
                for a in range(0, len(counts), 1000):
                    b = min(a + 1000, len(counts))
                    raw = [flat[e - c : e].tobytes() for e, c in zip(ends[a:b].tolist(), counts[a:b].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs_in[a:b], pa.int64()), pa.array(at + (ends - counts)[a:b]), pa.array(counts[a:b]), pa.array(raw, pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    placed = with_offsets(frames).select("at", "n_ids", "doc_ids", "counts", "blocks", "checks")
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
