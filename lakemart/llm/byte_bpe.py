"""Byte-level BPE by prefix dynamic programming, and back.

The encoding of a prefix is unique, so each byte prefix of a piece has one last token. It is a token that the prefix ends in
and that stays apart from the last token of what is before it; exactly one does. A table of these last tokens, one
for each byte, is the encoding: walking it from the end gives the ids. Appending extends the table and changes nothing in
it; after an edit it is refilled from there until it agrees with the former one for the length of the longest token.

Two tokens stay apart if merging both's bytes by rank gives the two again. What touches across the border between them are
the ends of their own merges, from single bytes up to the tokens: a pair of such ends that is a token, and of lower rank than
either's next merge, would have merged first. Answers are kept. Texts are cut by the public
pattern, each match is a piece of its own, and a match that is a token is that token.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.textops import Encoder, binary_column, by_bytes, is_space, release_memory

KNOWN_PAIRS = 1 << 18
KNOWN_PIECES = 1 << 16
LONG_PIECE = 64

# A letter, a number, white space and something else, each beyond ASCII.
STAND_INS = {r"\p{L}": "é", r"\p{N}": "²", r"\s": "\xa0", "": "§"}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _pattern() -> tuple[object, dict[int, str]]:
    """The public pattern, and stand-ins for letters that the library (its Unicode version) puts in another class."""
    import public_tokenizers
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    single = {bytes([i]): i for i in range(256)}

    def codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), "<u4")

    theirs, differ = {}, np.empty(0, np.uint32)
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        probe = tiktoken.Encoding("probe", pat_str=f"{kind}+", mergeable_ranks=single, special_tokens={})
        theirs[kind] = codes(bytes(probe.encode_ordinary(every)).decode())
        differ = np.union1d(differ, np.setxor1d(theirs[kind], codes("".join(regex.findall(f"{kind}+", every)))))
    stand_ins = dict.fromkeys(differ.tolist(), STAND_INS[""])
    for kind, found in theirs.items():
        stand_ins.update(dict.fromkeys(np.intersect1d(differ, found).tolist(), STAND_INS[kind]))
    return regex.compile(public_tokenizers.PATTERN), stand_ins


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class TokenBytes:
    """The bytes of each id: all that decoding needs."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        self.sizes = np.fromiter(map(len, table), np.int64, len(table))
        self.at = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, one after the other."""
        sizes = self.sizes[ids]
        shift = self.at[ids] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


class PrefixBpe:
    """Last tokens of byte prefixes under the ranks of a file (base64 token and rank in each line, every byte a token)."""

    def __init__(self, path: str):
        import ahocorasick

        self.ranks = read_ranks(path)
        self.longest = max(map(len, self.ranks))
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.sizes = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))
        self._apart: dict[tuple[int, int], bool] = {}
        self._made: dict[int, tuple[int, int] | None] = {}
        self._ends: dict[tuple[int, bool], list[int] | None] = {}

    def merged(self, data: bytes, until: int = 1) -> list[int]:
        """Ids by merging the adjacent pair of least rank, the first of equal ones, until none is a token or ``until`` are left
        (short data only)."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > until:
            rank, i = min((self.ranks.get(a + b, len(self.bytes_of)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == len(self.bytes_of):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the tokens can be neighbours; with ``left`` -1, whether ``right`` can begin a piece."""
        known = self._apart.get((left, right))
        if known is None:
            if len(self._apart) >= KNOWN_PAIRS:
                self._apart.clear()
            known = self._apart[left, right] = self._meet(left, right)
        return known

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that ``token`` is merged from; empty for a byte, None if merges do not lead to it or ranks do not
        ascend on the way."""
        if token not in self._made:
            data = self.bytes_of[token]
            halves = () if len(data) == 1 else tuple(self.merged(data, 2))
            if halves and (len(halves) != 2 or max(halves) >= token or any(self._halves(t) is None for t in halves)):
                halves = None
            self._made[token] = halves
        return self._made[token]

    def _spine(self, token: int, right: bool) -> list[int] | None:
        """What lies at the right or left end of ``token`` while it is merged, from itself down to a byte."""
        if (token, right) not in self._ends:
            out, halves = [token], self._halves(token)
            while halves:
                out.append(halves[1 if right else 0])
                halves = self._halves(out[-1])
            self._ends[token, right] = None if halves is None else out
        return self._ends[token, right]

    def _meet(self, left: int, right: int) -> bool:
        ours, theirs = [] if left < 0 else self._spine(left, True), self._spine(right, False)
        if ours is None or theirs is None:
            pair = [right] if left < 0 else [left, right]
            return self.merged(b"".join(self.bytes_of[t] for t in pair)) == pair
        i, j, never = len(ours) - 1, len(theirs) - 1, len(self.bytes_of)
        while i >= 0:
            mine, other = ours[i - 1] if i else never, theirs[j - 1] if j else never
            across = self.ranks.get(self.bytes_of[ours[i]] + self.bytes_of[theirs[j]], never)
            if across < mine and across <= other and across < never:
                return False
            if mine == other == never:
                return True
            if mine <= other:
                i -= 1
            else:
                j -= 1
        return True

    def extend(self, data: bytes, last: array, former: array | None = None, moved: int = 0, after: int = 0) -> bool:
        """Fill ``last`` up to the length of ``data``. With ``former``, whose bytes lie ``moved`` places earlier from ``after``
        on, stop as soon as the rest must equal it and say so."""
        base = max(0, len(last) - self.longest + 1)
        agreed, apart = 0, self._apart
        for end, (size, token) in self.automaton.iter(data[base:].decode("latin-1")):
            end += base
            if end < len(last):
                continue
            start = end - size + 1
            left = last[start - 1] if start else -1
            fits = apart.get((left, token))
            if fits is None:
                fits = self.stay_apart(left, token)
            if fits:
                last.append(token)
                if former is not None and end >= after:
                    agreed = agreed + 1 if former[end - moved] == token else 0
                    if agreed > self.longest:
                        return True
        return False

    def ids(self, data: bytes, last: array) -> list[int]:
        """The encoding of ``data`` read off its last tokens; data that is a token is that token."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        out, at = [], len(data) - 1
        while at >= 0:
            out.append(last[at])
            at -= len(self.bytes_of[last[at]])
        out.reverse()
        return out

    def encode(self, data: bytes) -> list[int]:
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        last = array("i")
        self.extend(data, last)
        return self.ids(data, last)


class Piece:
    """One piece under change: its bytes and the last token of each prefix."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", array("i")
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; what is stored stays as it is."""
        self.data += more
        self.bpe.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of bytes ``start`` to ``stop``; returns how many prefixes were computed again."""
        former, after, moved = self.last, start + len(new), len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = former[:start]
        if self.bpe.extend(self.data, self.last, former, moved, after):
            done = len(self.last)
            self.last += former[done - moved :]
            return done - start
        return len(self.last) - start

    def ids(self) -> list[int]:
        return self.bpe.ids(self.data, self.last)


class ByteBpeEncoder(Encoder):
    """Ids of whole columns: each distinct segment is cut by the pattern and encoded once."""

    def __init__(self, path: str):
        self.bpe, (self.pattern, self.stand_ins) = PrefixBpe(path), _pattern()
        self.keep_space, self.fold, self.added = True, False, None  # ranks know no added tokens: they are plain text
        self.width = np.uint16 if len(self.bpe.bytes_of) <= 1 << 16 else np.uint32
        self._pieces: dict[str, list[int]] = {}
        self._forget()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encode_text(t) for t in texts]

    def encode_text(self, text: str) -> list[int]:
        out: list[int] = []
        seen = text if text.isascii() else text.translate(self.stand_ins)
        for match in self.pattern.finditer(seen):
            piece = text[match.start() : match.end()]
            ids = self._pieces.get(piece)
            if ids is None:
                ids = self.bpe.encode(piece.encode())
                if len(piece) <= LONG_PIECE:
                    if len(self._pieces) >= KNOWN_PIECES:
                        self._pieces.clear()
                    self._pieces[piece] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def token_bytes(path: str) -> TokenBytes:
    return TokenBytes(path)


@lru_cache(maxsize=2)
def coder(path: str) -> ByteBpeEncoder:
    """One per worker process."""
    return ByteBpeEncoder(path)


def encode_texts(docs: DataFrame, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids)``: every text's ids, as unsigned little-endian 32-bit integers.

    Null and empty texts have none. Repeated rows and null ids stay as they are; an empty table gives none; other columns
    are ignored, whatever their names. Memory follows the longest single text: some 4 MB of rows are in work at a time.
    """
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in (small for batch in batches for small in by_bytes(batch, 1)):
            ids, counts = own.encode(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), binary_column(ids.astype("<u4"), counts).cast(pa.binary())], ["doc_id", "n_tokens", "ids"]
            )
        release_memory()

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids binary")


def decode_ids(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``encoded`` (a column ``ids`` as ``encode_texts`` gives it) with ``decoded``, the bytes of its tokens; null is empty."""
    path, names = ranks or default_ranks(), encoded.columns
    at = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = token_bytes(path)
        for batch in (small for batch in batches for small in by_bytes(batch, at)):
            rows = [np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(at).fill_null(b"")]
            flat = np.concatenate(rows)
            upto = np.concatenate([[0], np.cumsum(own.sizes[flat])])
            ends = upto[np.cumsum([len(r) for r in rows])]
            decoded = binary_column(own.decode(flat), np.diff(ends, prepend=0)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*names, "decoded"])
        release_memory()

    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit(None).cast("binary")).schema)


def _safe_cuts(data: np.ndarray) -> np.ndarray:
    """Byte places where the pattern always cuts, whatever is around: ASCII white space after an ASCII letter or digit."""
    alnum = ((data >= 48) & (data <= 57)) | ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
    return np.flatnonzero(is_space(data[1:]) & alnum[:-1]) + 1


def splice(own: ByteBpeEncoder, text: str, ids: np.ndarray, start: int, stop: int, new: str) -> tuple[str, np.ndarray]:
    """``text`` with letters ``start`` to ``stop`` replaced by ``new``, and its ids; only the stretch between the nearest
    safe cuts is encoded again."""
    data = np.frombuffer(text.encode(), np.uint8)
    a, b = len(text[:start].encode()), len(text[:stop].encode())
    cuts = _safe_cuts(data)
    before, behind = cuts[cuts < a], cuts[cuts > b]
    lo, hi = int(before[-1]) if len(before) else 0, int(behind[0]) if len(behind) else len(data)
    raw = data.tobytes()
    upto = np.concatenate([[0], np.cumsum(own.bpe.sizes[ids])])
    first, after = np.searchsorted(upto, [lo, hi])
    between = raw[lo:a].decode() + new + raw[b:hi].decode()
    fresh = np.array(own.encode_text(between), np.uint32)
    return text[:start] + new + text[stop:], np.concatenate([ids[:first], fresh, ids[after:]]).astype("<u4")


def apply_edits(
    docs: DataFrame, encoded: DataFrame, edits: DataFrame, ranks: str | None = None,
) -> DataFrame:
    """``(doc_id, text, n_tokens, ids)`` of the edited documents: ``docs(doc_id, text)`` with ``encoded(doc_id, ids)`` after
    ``edits(doc_id, start, stop, insert)``, at most one edit for each document (letters ``start`` to ``stop`` are replaced;
    places beyond the end mean the end; null ``insert`` deletes). Documents without an edit are not read into Python and not
    returned. Ids must be unique and not null."""
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            for row in batch.to_pylist():
                text, ids = row["text"] or "", np.frombuffer(row["ids"] or b"", "<u4")
                start = min(max(row["start"] or 0, 0), len(text))
                stop = min(max(row["stop"] or 0, start), len(text))
                text, ids = splice(own, text, ids, start, stop, row["insert"] or "")
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": [row["doc_id"]], "text": [text], "n_tokens": [len(ids)], "ids": [ids.tobytes()]}, schema=out
                )

    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    joined = edits.selectExpr("cast(doc_id as bigint) doc_id", "cast(start as bigint) start", "cast(stop as bigint) stop", "insert").join(
        docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), "doc_id"
    ).join(encoded.selectExpr("cast(doc_id as bigint) doc_id", "ids"), "doc_id")
    return joined.select("doc_id", "text", "ids", "start", "stop", "insert").mapInArrow(run, "doc_id bigint, text string, n_tokens bigint, ids binary")
