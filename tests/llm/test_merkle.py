import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.llm import merkle
from lakemart.llm.numbering import numbered
from lakemart.llm.queries import op12_merkle, prove_documents


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(row):
    out = [row]
    while len(row) > 1:
        row = [h(*row[i : i + 2]) for i in range(0, len(row), 2)]
        out.append(row)
    return out


def proof(tree, i):
    found = []
    for row in tree[:-1]:
        other = i ^ 1
        found.append((row[other], other < i) if other < len(row) else None)
        i >>= 1
    return found


def leaf(r, more=0):
    n_chars = None if r[3] is None else r[3] + more
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[1], r[2], n_chars, r[4])))


def brute(rows):
    """(doc_id, source, lang, n_chars, text) rows to the contract's results."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = mine, levels([leaf(r) for r in mine])
    top = levels([trees[lang][1][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        mine, tree = trees[lang]
        for i, r in enumerate(mine):
            path = proof(tree, i) + proof(top, j)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            at = leaf(r, 1) if tampered else leaf(r)
            for step in path:
                at = h(at) if step is None else h(step[0], at) if step[1] else h(at, step[0])
            beside = h("".join(s[0] for s in path if s))
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], beside, at, at == top[-1][0]))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, _key string, place int, leaf int, block int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], SCHEMA).repartition(parts)


def results(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_equals_brute_force(spark, height):
    rows = [(i, f"s{i % 3}", ["en", "de", None, "Zulu", "é"][i % 5 if i % 2 else 0], i * 3, "x" * i) for i in range(-3, 60)]
    rows += [(None, None, None, None, None), (None, "a", "en", 5, "t"), (7, "s1", "en", 21, "xxxxxxx"), (7, "s1", "en", 21, "xxxxxxx"), (200, "", "solo", 0, "")]
    assert results(prove_documents(table(spark, rows), block_height=height)) == sorted(brute(rows), key=str)


def test_empty_and_single(spark):
    assert results(prove_documents(table(spark, []))) == []
    one = [(5, "s", "en", 3, "abc")]
    assert results(prove_documents(table(spark, one))) == brute(one)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = results(op12_merkle(spark, "/root/testdata/sf0.01"))
    assert got == sorted(brute(rows), key=str) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("levels_", range(1, 9))
def test_addresses_are_a_layout(levels_):
    places = [merkle.address(level, np.arange(1 << level), levels_).tolist() for level in range(levels_)]
    assert sorted(p for row in places for p in row) == list(range((1 << levels_) - 1))
    assert places[0] == [0]
    top = levels_ // 2
    for level in range(top):  # the upper half comes first
        assert max(places[level]) < (1 << top) - 1


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 16))
def test_changed_leaf_is_found(n):
    digests = [sha256(bytes([i])).digest() for i in range(n)]
    height = (n - 1).bit_length()
    nodes = merkle.build_block(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32), height)
    assert nodes[0].tobytes().hex() == levels([d.hex() for d in digests])[-1][0]
    found, sides = merkle.siblings(nodes, height, n, np.arange(n))
    for i in range(n):
        beside = found[i][sides[i] != merkle.ALONE].tobytes()
        assert merkle.fold(digests[i], beside, sides[i].tobytes()) == nodes[0].tobytes()
        assert merkle.fold(sha256(b"other").digest(), beside, sides[i].tobytes()) != nodes[0].tobytes()


def test_numbering_splits_a_large_group(spark):
    df = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"), (F.col("id") * 7919 % 1000).alias("o"), (F.col("id") % 5).alias("w"),
    )
    got = numbered(df, "g", ["o"], "w").collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append(r)
    assert sum(map(len, by_group.values())) == 5000
    for rows in by_group.values():
        rows.sort(key=lambda r: r.place)
        assert [r.place for r in rows] == list(range(len(rows)))
        assert [r.o for r in rows] == sorted(r.o for r in rows)
        ahead = 0
        for r in rows:
            assert r.before == ahead
            ahead += r.w
