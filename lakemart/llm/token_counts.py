"""Word-piece counts by a linear longest-match automaton.

A trie of the vocabulary gets failure links: from a node, the node where matching goes on after the longest pieces
that cover what was read have been popped, and how many those are. A word is then read once, letter by letter; pieces
are counted and never built. Words are the runs of anything but ASCII white space, each with the word mark in front; a word
that the greedy cover cannot finish counts as one unknown piece. A distinct word of a batch is read once.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.textops import pieces, span_hashes, text_bytes, words

MARK = "▁"
KNOWN_WORDS = 1 << 21


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Automaton:
    """Longest-match counting over a list of pieces. Node 0 is the root; a failure of -1 means there is none."""

    def __init__(self, vocabulary: Iterable[str]):
        self.child: list[dict[str, int]] = [{}]
        whole: set[int] = set()
        for piece in vocabulary:
            node = 0
            for c in piece:
                to = self.child[node].get(c)
                if to is None:
                    to = self.child[node][c] = len(self.child)
                    self.child.append({})
                node = to
            if node:
                whole.add(node)
        self.fail, self.pops = [-1] * len(self.child), [0] * len(self.child)
        queue = deque([0])
        while queue:
            above = queue.popleft()
            for c, node in self.child[above].items():
                queue.append(node)
                if node in whole:
                    self.fail[node], self.pops[node] = 0, 1
                    continue
                popped, at = self.pops[above], self.fail[above]
                while at >= 0 and c not in self.child[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.pops[node] = self.child[at][c], popped

    def count(self, word: str) -> int:
        """The number of pieces of a word, -1 if they do not cover it."""
        child, fail, pops, node, total = self.child, self.fail, self.pops, 0, 0
        for c in word:
            while (to := child[node].get(c)) is None:
                if (back := fail[node]) < 0:
                    return -1
                total += pops[node]
                node = back
            node = to
        while node:
            if (back := fail[node]) < 0:
                return -1
            total += pops[node]
            node = back
        return total


class Counter:
    """Counts for the words of Arrow columns; the counts of known words are kept in sorted arrays of bounded length."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        usual = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        self.automaton = Automaton(model.id_to_piece(i) for i in usual)
        self.keys, self.values = np.empty(0, np.uint64), np.empty(0, np.int64)

    def _of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        keys, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        where = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[where] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new, values, raw = np.flatnonzero(~known), np.empty(len(keys), np.int64), data.tobytes()
        spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
        values[new] = [self.automaton.count(MARK + raw[s:e].decode("utf-8", "replace")) for s, e in spans]
        values[known] = self.values[where[known]]
        if len(self.keys) + len(new) > KNOWN_WORDS:
            self.keys, self.values = self.keys[:0], self.values[:0]
        elif len(new):
            everything = np.concatenate([self.keys, keys[new]])
            order = np.argsort(everything, kind="stable")
            self.keys, self.values = everything[order], np.concatenate([self.values, values[new]])[order]
        return values[back]

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(words, pieces, unknown)`` of each text."""
        data, offsets = text_bytes(column)
        starts, ends, first = words(data, offsets)
        cuts, counts = np.append(starts, len(data)), [np.empty(0, np.int64)]
        for a, b in pieces(cuts):
            lo = cuts[a]
            counts.append(self._of_words(data[lo : ends[b - 1]], starts[a:b] - lo, ends[a:b] - lo))
        counts = np.concatenate(counts)
        covered = np.concatenate([[0], np.cumsum(np.where(counts < 0, 1, counts))])[first]
        unknown = np.concatenate([[0], np.cumsum(counts < 0)])[first]
        return np.diff(first), np.diff(covered), np.diff(unknown)


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_tokens, n_unknown)`` for every row; an unknown word is one token.

    Null and empty texts and texts of white space have 0 of each; repeated rows give repeated results, an empty table
    none; a null id stays null; other columns are ignored. Letters are compared as they are, without normalisation.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _counter(path).count(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts)], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
