import random

import pytest
from pyspark.sql import functions as F

from lakemart.llm.topk import nearest_codes, probing_order, segment_widths, sign_code


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(rows, queries, k):
    known = {i: c for i, c in rows if i is not None and c is not None}
    out = []
    for q in sorted(set(queries) & set(known)):
        near = sorted((bin((known[q] ^ c) & (2**64 - 1)).count("1"), i) for i, c in known.items() if i != q)[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


@pytest.mark.parametrize("n,seed", [(3, 1), (300, 2), (3000, 3)])
def test_equal_to_brute_force(spark, rows, n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    made = []
    for i in range(n):
        code = rng.choice(centres) if rng.random() < 0.6 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 0, 1, 3, 9])):
            code ^= 1 << rng.randrange(64)
        made.append((i * 5, signed(code)))
    made += [(10**6 + i, signed(centres[0])) for i in range(n // 3)] + [(None, 5), (2 * 10**6, None)]
    table = spark.createDataFrame([(i, c, "x") for i, c in made], "id long, code long, distance string")
    picked = [i for i, _ in made if i is not None and i % 20 == 0]
    got = nearest_codes(table, table.where("id % 20 = 0"), 7)
    assert rows(got) == sorted(brute(made, picked, 7), key=str)


def test_codes_of_odd_vectors(spark):
    inf = float("inf")
    vectors = [None, [], [1.0] * 63, [1.0] * 64, [-1.0] * 63 + [2.0], [0.0] * 64, [float("nan")] + [1.0] * 63, [inf] + [1.0] * 63, [None] + [1.0] * 63]
    got = spark.createDataFrame([(v,) for v in vectors], "v array<float>").select(sign_code(F.col("v"))).collect()
    assert [r[0] for r in got] == [None, None, None, -1, -(2**63), 0, None, None, None]


def test_empty_table(spark):
    none = spark.createDataFrame([], "id long, code long")
    assert nearest_codes(none, none).count() == 0


def test_least_code_of_repeated_ids(spark, rows):
    made = [(i % 40, signed(random.Random(i).getrandbits(64))) for i in range(120)] + [(7, 5), (7, -5)]
    least = {}
    for i, c in made:
        least[i] = min(c, least.get(i, c))
    for parts in (1, 5):
        table = spark.createDataFrame(made, "id long, code long").repartition(parts, "code")
        assert rows(nearest_codes(table, table.where("id % 4 = 3"), 3)) == sorted(brute(list(least.items()), [i for i in least if i % 4 == 3], 3), key=str)


def test_segments_grow_one_at_a_time():
    assert [segment_widths(n) for n in (1, 10_256, 51_282)] == [[8] * 8, [13, 13, 13, 13, 12], [13, 13, 13, 13, 12]]
    assert [len(segment_widths(n)) for n in (500, 10**9, 10**11)] == [8, 3, 2]
    for n in (1, 51_282, 10**9):
        widths = segment_widths(n)
        steps = [(a, j) for a, picked in probing_order(widths) for j in picked]
        assert steps == sorted((a, j) for j, w in enumerate(widths) for a in range(w + 1))
    assert [p for a, p in probing_order([13] * 4 + [12]) if a == 3] == [[0], [1], [2], [3], [4]]
