import subprocess
import sys

import numpy as np
import pyarrow as pa

from lakemart.llm import textops
from lakemart.llm.ngram_join import shingle_sets


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array(["one two  three", None, "x " * 300 + "y" * 400 + " z", "", "tail"])
    data, offsets = textops.text_bytes(texts)
    starts, ends, _ = textops.words(data, offsets)
    whole = textops.span_hashes(data, starts, ends)
    assert np.array_equal(textops.word_hashes(data, starts, ends), whole)
    before = [(a, s.tolist(), c.tolist()) for a, s, c in shingle_sets(texts, 3)]
    monkeypatch.setattr(textops.pieces, "__defaults__", (50,))
    assert np.array_equal(textops.word_hashes(data, starts, ends), whole)
    assert [(a, s.tolist(), c.tolist()) for a, s, c in shingle_sets(texts, 3)] == before


def test_a_long_text_takes_bounded_tables():
    """Peak memory of shingling one text of 40 MB, above that of the start, in a process of its own."""
    code = """
import resource, pyarrow as pa
from lakemart.llm.ngram_join import shingle_sets
text = pa.array([" ".join(f"word{i}" for i in range(3_600_000))])
list(shingle_sets(text.slice(0, 0), 5))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
(_, sets, counts), = shingle_sets(text, 5)
print(len(text[0].as_py()), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 40_000_000 and int(out[1]) < 700
