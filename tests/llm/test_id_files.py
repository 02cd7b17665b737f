import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakemart.llm import id_files
from lakemart.llm.id_files import decode_blocks, encode_blocks, read_frame, read_ids, write_ids
from lakemart.llm.textops import Encoder

BLOCKS = st.lists(st.one_of(
    st.lists(st.integers(0, 65535), min_size=1, max_size=60), st.lists(st.sampled_from([0, 1, 65535, 300]), min_size=1, max_size=200),
), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(BLOCKS)
def test_blocks_come_back(blocks):
    blocks = sorted((np.array(b, np.uint16) for b in blocks), key=len, reverse=True)
    back = decode_blocks(encode_blocks(blocks), np.array([len(b) for b in blocks]))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, back))


def test_each_block_decodes_alone_and_repeats_cost_little():
    rng = np.random.default_rng(1)
    blocks = [np.tile(rng.integers(0, 49_000, 50), 60).astype(np.uint16), rng.integers(0, 49_000, 2000).astype(np.uint16)]
    coded = encode_blocks(blocks)
    assert len(coded[0]) < 1000 and len(coded[1]) < 2.4 * 2000
    for b, c in zip(blocks, coded):
        assert (decode_blocks([c], np.array([len(b)]))[0] == b).all()


def test_damage_is_found():
    coded, checks = id_files._frame(np.arange(5000).astype(np.uint16))
    bad = bytearray(coded[0])
    bad[100] ^= 8
    with pytest.raises(ValueError, match="checksum"):
        read_frame([bytes(bad)], checks, 5000)


def test_files_hold_the_ids_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_files, "BLOCK", 512)
    monkeypatch.setattr(id_files, "LANES", 4)
    rows = [(7, None), (3, ""), (3, "same id"), (3, "same id"), (None, "null id"), (1, "Some words, and more. " * 900)]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select((F_id() + 100).alias("doc_id"), "text")
    docs = docs.union(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    write_ids(docs, str(tmp_path / "ids"))
    got = [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in read_ids(spark, str(tmp_path / "ids")).collect()]
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    order = [(r[0] is not None, r[0] or 0) for r in got]
    assert order == sorted(order)
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((str(r.doc_id), plain.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in docs.collect())
    assert sorted((str(r[0]), r[3]) for r in got) == want and all(r[2] == len(r[3]) for r in got)


def F_id():
    from pyspark.sql import functions as F

    return F.col("doc_id")


def test_empty_table(spark, tmp_path):
    write_ids(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"))
    assert read_ids(spark, str(tmp_path / "none")).count() == 0


def test_many_lanes_advance_together(monkeypatch):
    """A step costs its numpy calls however few lanes it moves, so a million ids take few steps; their bytes stay few."""
    steps, foretell = [], id_files._Model.foretell
    monkeypatch.setattr(id_files._Model, "foretell", lambda model, n: steps.append(n) or foretell(model, n))
    ids = np.minimum(np.random.default_rng(5).zipf(1.3, 1_000_000), 49_000).astype(np.uint16)
    coded, checks = id_files._frame(ids)
    assert (read_frame(coded, checks, len(ids)) == ids).all()
    assert len(steps) <= 2 * 2048 and sum(steps) == 2 * len(ids)
    assert sum(map(len, coded)) < 1.3 * len(ids)


def test_six_thousand_blocks_advance_together(monkeypatch):
    """A frame of ten million ids takes as many steps as one block, and order 0 takes no row of frequencies for each id."""
    steps, foretell = [], id_files._Model.foretell
    monkeypatch.setattr(id_files._Model, "foretell", lambda model, n: steps.append(n) or foretell(model, n))
    monkeypatch.setattr(id_files, "BLOCK", 40)
    ids = np.minimum(np.random.default_rng(6).zipf(1.3, 40 * 6000), 49_000).astype(np.uint16)
    coded, checks = id_files._frame(ids)
    assert (read_frame(coded, checks, len(ids)) == ids).all()
    assert len(steps) == 2 * 40


def test_frequencies_of_a_block_are_counted_anew():
    """Ids without order, a few of them frequent, take no more than their entropy and two bytes for the first sight of each."""
    rng = np.random.default_rng(7)
    chance = 1 / np.arange(1, 301)
    blocks = [rng.choice(rng.choice(49_000, 300, False), 2048, p=chance / chance.sum()).astype(np.uint16) for _ in range(20)]
    entropy = -(chance / chance.sum() * np.log2(chance / chance.sum())).sum() / 8
    first = 2 * sum(len(np.unique(b)) for b in blocks)
    coded = encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, decode_blocks(coded, np.full(20, 2048))))
    assert sum(map(len, coded)) < 20 * 2048 * entropy + first


@pytest.mark.parametrize("many", [1, 300])
def test_new_segments_go_to_the_tokenizer_in_runs(monkeypatch, many):
    sent, encode = [], Encoder._encode
    monkeypatch.setattr(Encoder, "_encode", lambda coder, texts, **how: sent.extend(texts) or encode(coder, texts, **how))
    odd = ["café café STRASSE straße İstanbul ǅ ΣΣ naïve", "a b\u0085c ́x  y 's don't 12 3", "<|endoftext|> <|ENDOFTEXT|> \x00\x1c\x1f .. !?", "", " \t\n"]
    texts = odd + [f"w{i:x}q z{i * 7919:x}, {chr(0xe0 + i % 30)}k{i}" for i in range(many)]
    ids, counts = Encoder(public_tokenizers.path("word_bpe_49k.json"), "word").encode(pa.array(texts))
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert len(sent) < 40
