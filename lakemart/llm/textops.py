"""Vectorised work on the bytes of Arrow string columns: spans, span hashes, cached tokenisation.

A batch is handled in pieces of a few MB, so memory follows the piece and not the batch or its longest text.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
ROWS_BYTES = 1 << 22
KNOWN_SEGMENTS = 1 << 21
KNOWN_IDS = 1 << 23
LONG_SEGMENT = 64
JOINED = 128

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


_UNCHANGED = re.compile("[\x00-\x7f\xa1-\u02ff]*")  # no mark that joins a letter, no white space but ASCII's


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


def _spread_bytes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


_BYTE_VALUE = _spread_bytes()


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins (one more entry than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or not column.buffers()[2]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def is_space(data: np.ndarray) -> np.ndarray:
    """Space and the five ASCII controls from tab to carriage return."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes. Spans ascend and lie within one piece of ``data``."""
    size = 1 << max(16, int(len(data) - 1).bit_length())
    up, down = _powers(size)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def pieces(cuts: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``cuts`` (ascending byte positions, the last one the end) spanning about ``size`` bytes."""
    at = 0
    while at < len(cuts) - 1:
        to = int(np.searchsorted(cuts, cuts[at] + size, "right")) - 1
        to = min(max(to, at + 1), len(cuts) - 1)
        yield at, to
        at = to


def by_bytes(batch: pa.RecordBatch, column: int, size: int = ROWS_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose ``column`` (text or bytes) has about ``size`` bytes, or of one longer row; none if empty."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts, at = np.concatenate([[0], np.cumsum(lengths)]), 0
    while at < len(lengths):
        to = int(np.searchsorted(cuts, cuts[at] + size, "right")) - 1
        to = min(max(to, at + 1), len(lengths))
        yield batch.slice(at, to - at)
        at = to


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes`` of ascending spans, in pieces: tables are as long as a piece (or one span), not as the data."""
    cuts, out = np.append(starts, len(data)), [np.empty(0, np.uint64)]
    for a, b in pieces(cuts):
        lo, hi = int(cuts[a]), int(ends[b - 1])
        out.append(span_hashes(data[lo:hi], starts[a:b] - lo, ends[a:b] - lo))
    return np.concatenate(out)


def release_memory() -> None:
    """Hand back to the machine what this worker has used and holds for later; called where a partition ends."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: the words (runs of bytes other than ASCII white space) and each text's first word."""
    solid = ~is_space(data)
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    inner = offsets[1:] - 1
    after[inner[inner >= 0]] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _rare_spaces(data: np.ndarray) -> np.ndarray:
    """Positions of white space beyond ASCII (fixed values: its UTF-8 forms)."""
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    at = at[at + 1 < len(data)]
    one, two = data[at], data[at + 1]
    three = data[np.minimum(at + 2, len(data) - 1)]
    found = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
    found |= (one == 0xE1) & (two == 0x9A) & (three == 0x80)
    found |= (one == 0xE2) & (two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))
    found |= (one == 0xE2) & (two == 0x81) & (three == 0x9F)
    found |= (one == 0xE3) & (two == 0x80) & (three == 0x80)
    return at[found]


class Encoder:
    """Token ids of whole texts by a byte-pair tokenizer file, each distinct segment encoded once.

    A segment begins at ASCII white space after something else, or at ASCII punctuation after an ASCII letter or digit.
    The pre-tokenizers of both kinds (``byte``: white space kept; ``word``: lower case, white space dropped) always
    split there, so the ids of the segments, one after the other, are those of the text. White space beyond ASCII
    could join a run of spaces that a segment would cut; for ``byte`` such texts are encoded whole. An added token of the
    file (``<|endoftext|>``) is found in the text as it stands, as the tokenizer does, and is a segment of its own.
    Where white space is dropped, new segments whose letters no normalisation changes go to the tokenizer in runs with a
    space between, where it always splits; the bytes that the ids stand for tell where each one ends.
    Known segments of up to 64 bytes live in sorted arrays of bounded length, with their ids; a hash of 64 bits stands for one.
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = self.plain = Tokenizer.from_file(path)
        letters = "".join(x for x in map(chr, range(0x300)) if _UNCHANGED.fullmatch(x) and x == x.lower() and (x == " " or not x.isspace()))
        if self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str(letters) == letters:
            self.plain = Tokenizer.from_file(path)  # for texts that normalising would leave as they are
            self.plain.normalizer = normalizers.Sequence([])
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        names = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.keep_space, self.fold = kind == "byte", kind == "word"
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        vocabulary = self.tokenizer.get_vocab()
        self.spelt = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # the bytes that an id stands for
        self.spelt[list(vocabulary.values())] = [len(t.removesuffix("</w>")) for t in vocabulary]
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.lengths, self.flat = np.empty(0, np.int64), np.empty(0, self.width)

    def _encode(self, texts: list[str], plain: bool = False) -> list[list[int]]:
        tokenizer = self.plain if plain else self.tokenizer
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_runs(self, texts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)`` of segments that may be joined; ``sizes`` are their bytes without white space."""
        parts = [np.empty(0, self.width)]
        for a in range(0, len(texts), 64 * JOINED):  # what the tokenizer returns is many times as large as the ids
            runs = self._encode([" ".join(texts[i : i + JOINED]) for i in range(a, min(a + 64 * JOINED, len(texts)), JOINED)], plain=True)
            parts.append(np.fromiter(chain.from_iterable(runs), self.width, sum(map(len, runs))))
        flat = np.concatenate(parts)
        spelt, ends = np.concatenate([[0], np.cumsum(self.spelt.take(flat))]), np.cumsum(sizes)
        upto = np.minimum(np.searchsorted(spelt, ends), len(flat))
        if (spelt[upto] != ends).any() or not self.spelt.take(flat).all():
            return self._encode_each(texts)
        return flat, np.diff(upto, prepend=0)

    def _encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._encode(texts)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), self.width, int(counts.sum())), counts

    def _segments(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)`` of the segments of one piece. One that fills a piece alone is not hashed."""
        if len(starts) == 1 and len(data) > PIECE:
            ids = np.array(self._encode([data.tobytes().decode("utf-8", "replace")])[0], self.width)
            return ids, np.array([len(ids)])
        keys, first, back = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        where = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[where] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        begin, end = starts[first[new]], ends[first[new]]
        raw = data.tobytes()
        texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(begin.tolist(), end.tolist())]
        if self.fold:
            joined = np.fromiter((x.isascii() or (_UNCHANGED.fullmatch(x) is not None and x == x.lower()) for x in texts), bool, len(texts))
            order = np.argsort(~joined, kind="stable")
            new, begin, end, n = new[order], begin[order], end[order], int(joined.sum())
            texts = [texts[k] for k in order.tolist()]
            solid = np.concatenate([[0], np.cumsum(~is_space(data))])
            parts = [self._encode_runs(texts[:n], (solid[end] - solid[begin])[:n]), self._encode_each(texts[n:])]
            fresh, counts = (np.concatenate(x) for x in zip(*parts))
        else:
            fresh, counts = self._encode_each(texts)
        lengths, at = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        lengths[new], at[new] = counts, len(self.flat) + np.cumsum(counts) - counts
        if len(self.keys):
            lengths[known], at[known] = self.lengths[where[known]], self.at[where[known]]
        flat = np.concatenate([self.flat, fresh])
        per = lengths[back]
        take = np.repeat(at[back] - (np.cumsum(per) - per), per) + np.arange(int(per.sum()))
        out = flat[take]
        short = end - begin <= LONG_SEGMENT
        keep, kept = new[short], counts[short]
        if len(self.keys) + len(keep) > KNOWN_SEGMENTS or len(self.flat) + int(kept.sum()) > KNOWN_IDS:
            self._forget()
        elif len(keep):
            order = np.argsort(keys_all := np.concatenate([self.keys, keys[keep]]), kind="stable")
            self.keys = keys_all[order]
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(kept) - kept])[order]
            self.lengths = np.concatenate([self.lengths, kept])[order]
            self.flat = np.concatenate([self.flat, fresh[np.repeat(short, counts)]])
        return out, per

    def _added_tokens(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Where added tokens stand, the leftmost first and none across two texts."""
        spans, at, view = [], 0, memoryview(data)
        while self.added and (found := self.added.search(view, at)):
            start, end = found.span()
            inside = end <= offsets[np.searchsorted(offsets, start, "right")]
            if inside:
                spans.append((start, end))
            at = end if inside else start + 1
        return spans

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)``: the ids of all texts one after the other and how many each text has."""
        data, offsets = text_bytes(column)
        n = len(offsets) - 1
        if not len(data):
            return np.empty(0, self.width), np.zeros(n, np.int64)
        whole: dict[int, np.ndarray] = {}
        if self.keep_space and len(rare := _rare_spaces(data)):
            for i in np.unique(np.searchsorted(offsets, rare, "right") - 1).tolist():
                ids = self._encode([column[i].as_py()])[0]
                whole[i] = np.array(ids, self.width)
        added = self._added_tokens(data, offsets)
        if self.fold:
            data = lower_ascii(data)
        space = is_space(data)
        alnum = ((data >= 48) & (data <= 57)) | ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
        mark = (data < 128) & ~alnum & ~space & (data > 32) & (data < 127)
        begin = np.empty(len(data), bool)
        begin[:1] = True
        begin[1:] = (space[1:] & ~space[:-1]) | (mark[1:] & alnum[:-1])
        begin[offsets[:-1][offsets[:-1] < len(data)]] = True
        for start, end in added:
            begin[start + 1 : end] = False
            begin[start] = True
            begin[end : end + 1] = True
        del space, alnum, mark
        cuts = np.append(np.flatnonzero(begin), len(data))
        ids, per = [], []
        for a, b in pieces(cuts):
            lo = cuts[a]
            got = self._segments(data[lo : cuts[b]], cuts[a:b] - lo, cuts[a + 1 : b + 1] - lo)
            ids.append(got[0])
            per.append(got[1])
        ids, upto = np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(per))])
        bounds = upto[np.searchsorted(cuts, offsets)]
        counts = np.diff(bounds)
        if whole:
            parts = [whole.get(i, ids[bounds[i] : bounds[i + 1]]) for i in range(n)]
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, n)
        return ids, counts


@lru_cache(maxsize=4)
def encoder(path: str, kind: str) -> Encoder:
    """One per worker process."""
    return Encoder(path, kind)


def binary_column(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``data`` as a large binary column; ``counts`` are in items."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * data.dtype.itemsize
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
