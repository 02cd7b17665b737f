"""Sketches hashed in Arrow against plain ones, letter runs, and texts that no rule touches."""

import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.functions import minhash as M
from lakemart.functions import sets as S

WORDS = st.lists(st.sampled_from(["a", "b", "the", "x9", "of"]), max_size=9).map(" ".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(WORDS, max_size=4))
def test_each_shingle_is_hashed_once(texts):
    coefs = M.coefficients()
    for text, row in zip(texts, M.sketch_rows(pa.array(texts, pa.string()), 3, coefs).to_pylist()):
        words = text.split()
        runs = {" ".join(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else set(words)
        digests = [hashlib.sha256(r.encode()).digest() for r in runs]
        assert row["shingles"] == sorted(int.from_bytes(d[:8], "big", signed=True) for d in digests)
        heads = [int.from_bytes(d[:4], "big") % M.PRIME for d in digests]
        sig = [min((h * a + b) % M.PRIME for h in heads) if heads else 0 for a, b in coefs]
        assert row["signature"] == sig
        cut = [",".join(map(str, sig[i : i + M.ROWS])) for i in range(0, len(sig), M.ROWS)]
        assert row["bands"] == [int(hashlib.sha256(c.encode()).hexdigest()[:15], 16) for c in cut]


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("ab \x7fé日"), max_size=30))
def test_letter_runs(text):
    assert S.letter_runs(text, 9) == (len({text[i : i + 9] for i in range(len(text) - 8)}) if len(text) >= 9 else 1)
