import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakemart.llm.packing import pack
from lakemart.llm.textops import Encoder

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
ENCODERS = {k: Encoder(public_tokenizers.path(v), k) for k, v in FILES.items()}
PLAIN = {k: Tokenizer.from_file(public_tokenizers.path(v)) for k, v in FILES.items()}
PARTS = st.sampled_from([
    "the", " The", "don't", "'s", "\n", "\n\n", "  ", "\t", "\r\n", " ", ".", ",", "é", "é", "1", "23", "x9,", " ", "　 ", " ",
    "\x1c", "—,", "¿", "日本", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "_", "😀", "ß", "ſ", "Å", "\x85 ", "q" * 70, "\0",
])


@pytest.mark.parametrize("kind", FILES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.lists(PARTS, max_size=14).map("".join), st.text(max_size=20)), max_size=5))
def test_segments_give_the_ids_of_whole_texts(kind, texts):
    ids, counts = ENCODERS[kind].encode(pa.array(texts, pa.string()))
    want = [PLAIN[kind].encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_pieces_cover_each_id_once(spark):
    rows = [(5, "a b c " * 700), (1, None), (2, ""), (2, ""), (None, "x"), (3, "one two"), (9, "w " * 5000)]
    docs = spark.createDataFrame([(d, t, 7, 8) for d, t in rows], "doc_id long, text string, start int, ids int").repartition(3)
    got = pack(docs, length=64).collect()
    stream, seen = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length and 0 < r.length and r.offset + r.length <= 64
        for k in range(r.length):
            place = r.sequence_id * 64 + r.offset + k
            assert place not in stream
            stream[place] = int.from_bytes(r.ids[4 * k : 4 * k + 4], "little")
        seen.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    assert sorted(stream) == list(range(len(stream)))
    want = [PLAIN["byte"].encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows]
    assert len(stream) == sum(map(len, want)) and sorted(stream.values()) == sorted(i for w in want for i in w)
    by_doc = {}
    for r in sorted(got, key=lambda r: (r.doc_id or 0, r.start)):
        by_doc.setdefault(r.doc_id, bytearray()).extend(r.ids)
    for d in (5, 1, 3, 9, None):
        text = dict(rows)[d]
        ids = PLAIN["byte"].encode(text or "", add_special_tokens=False).ids + [1]
        assert zlib.crc32(bytes(by_doc[d])) == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
