import base64
import itertools
from hashlib import sha256

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import textops
from lakemart.llm.byte_bpe import Piece, PrefixBpe, apply_edits, coder, decode_ids, default_ranks, encode_texts, splice, token_bytes
from lakemart.llm.queries import op13_byte_bpe

with open(default_ranks(), "rb") as lines:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
WHOLE = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=RANKS, special_tokens={})
OWN, BYTES = coder(default_ranks()), token_bytes(default_ranks())
PARTS = st.sampled_from([
    "the", " The", "don't", "'s", "'", "r", "e", "\n", "\n\n", "  ", "\t", "\r\n", " ", ".", ",", "é", "1", "23", "x9,", " ", "　 ",
    " ", "\x1c", "—,", "¿", "日本", "<|endoftext|>", "_", "😀", "ß", "\x85 ", "q" * 70, "\0", "ab" * 40, "=" * 30, "aaaa", "\u0558", "\u088f", "\ua7ce",
])
TEXTS = st.one_of(st.lists(PARTS, max_size=14).map("".join), st.text(max_size=20), st.text("ab ", max_size=40))


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), TEXTS), max_size=5))
def test_columns_as_the_library(texts):
    ids, counts = OWN.encode(pa.array(texts, pa.string()))
    want = [PLAIN.encode_ordinary(t or "") for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert BYTES.decode(ids).tobytes() == "".join(t or "" for t in texts).encode()


def test_neighbours_as_merging_both():
    bpe, draw = OWN.bpe, np.random.RandomState(3)
    ids = [i for i, b in enumerate(bpe.bytes_of) if b]
    short = [i for i in ids if len(bpe.bytes_of[i]) <= 3]
    for pool, n in ((ids, 20_000), (short, 60_000)):
        for a, b in zip(draw.choice(pool, n).tolist(), draw.choice(pool, n).tolist()):
            assert bpe._meet(a, b) == (bpe.merged(bpe.bytes_of[a] + bpe.bytes_of[b]) == [a, b])
    assert all(bpe._meet(-1, i) == (bpe.merged(bpe.bytes_of[i]) == [i]) for i in ids[::37])


def test_ranks_that_do_not_ascend(tmp_path):
    tokens = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"bc": 257, b"cd": 258, b"ab": 259, b"abcd": 260, b"dd": 261, b"ddd": 262}
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in tokens.items()))
    plain = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=tokens, special_tokens={})
    bpe = PrefixBpe(str(path))
    for n in range(1, 8):
        for word in itertools.product(b"abcd", repeat=n) if n < 7 else [tuple(b"abcdabc"), tuple(b"ddddddd")]:
            assert bpe.encode(bytes(word)) == plain.encode_ordinary(bytes(word).decode())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 200), st.one_of(st.binary(max_size=30), TEXTS.map(str.encode))), max_size=8))
def test_pieces_under_change(edits):
    piece = Piece(OWN.bpe)
    for a, b, new in edits:
        a, b = sorted((min(a, len(piece.data)), min(b, len(piece.data))))
        if a == len(piece.data):
            stored = piece.last[:]
            piece.append(new)
            assert piece.last[: len(stored)] == stored
        else:
            piece.replace(a, b, new)
        fresh = Piece(OWN.bpe, piece.data)
        assert piece.last == fresh.last
        try:
            text = piece.data.decode()
        except UnicodeDecodeError:
            continue
        assert piece.ids() == WHOLE.encode_ordinary(text)


def test_names_of_added_tokens_are_plain_text():
    texts = ["<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "plain"]
    ids, counts = OWN.encode(pa.array(texts))
    want = [PLAIN.encode_ordinary(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_an_edit_touches_few_prefixes():
    piece = Piece(OWN.bpe, b"to be or not to be " * 2000)
    again = piece.replace(500, 502, b"is")
    assert again < 5 * OWN.bpe.longest and piece.last == Piece(OWN.bpe, piece.data).last


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(0, 60), st.integers(0, 60), TEXTS)
def test_splice_as_encoding_anew(text, a, b, new):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    got, ids = splice(OWN, text, np.array(PLAIN.encode_ordinary(text), "<u4"), a, b, new)
    assert got == text[:a] + new + text[b:] and ids.tolist() == PLAIN.encode_ordinary(got)


def test_every_letter_is_cut_as_the_library_does():
    every = [chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    text = "".join(f"a{c}1{c}.{c} " for c in every)
    assert OWN.encode_text(text) == PLAIN.encode_ordinary(text)


def check(rows, docs):
    want = []
    for doc_id, text in docs:
        ids = PLAIN.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((doc_id, len(ids), sha256(raw).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    check(op13_byte_bpe(spark, "/root/testdata/sf0.01").collect(), [tuple(r) for r in docs.collect()])


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "x y"), (None, None), (3, "word " * 200_000), (4, "é" * 60_000), (5, " ")]
    docs = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id long, text string, ids int, n_tokens int, decoded string").repartition(2)
    got = decode_ids(encode_texts(docs)).collect()
    assert sorted((r.doc_id or 0, r.decoded.decode()) for r in got) == sorted((d or 0, t or "") for d, t in rows)
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    assert decode_ids(encode_texts(docs.limit(0))).collect() == []


def test_edits_of_stored_documents(spark):
    texts = {1: "one two three", 2: "", 3: "don't stop now", 4: "left alone", 5: "ends here"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    edits = {1: (4, 7, "2"), 2: (0, 0, "new text"), 3: (3, 5, None), 5: (100, 200, "'re")}
    table = spark.createDataFrame([(k, *v) for k, v in edits.items()], "doc_id long, start long, stop long, insert string")
    got = {r.doc_id: r for r in apply_edits(docs, encode_texts(docs), table).collect()}
    assert set(got) == set(edits)
    assert {k: r.text for k, r in got.items()} == {1: "one 2 three", 2: "new text", 3: "don stop now", 5: "ends here're"}
    for r in got.values():
        assert np.frombuffer(r.ids, "<u4").tolist() == PLAIN.encode_ordinary(r.text) and r.n_tokens == len(PLAIN.encode_ordinary(r.text))


def test_known_segments_stay_bounded():
    own = textops.Encoder(public_tokenizers.path("byte_bpe_50k.json"), "byte")
    long = "".join(chr(0x4E00 + i % 5000) for i in range(100_000))
    for k in range(4):
        own.encode(pa.array([f"{k}" + long + " tail"]))
    assert len(own.flat) < 100


@pytest.mark.parametrize("size", [100, 3_000_000])
def test_unbroken_texts(size):
    text = "z" * size
    ids, _ = OWN.encode(pa.array([text]))
    assert BYTES.decode(ids).tobytes() == text.encode()
    assert textops._powers.cache_info().currsize <= 2 and all(len(textops._powers(n)[0]) <= textops.PIECE for n in (1 << 16,))
