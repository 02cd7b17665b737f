"""Parities, heads of sets, and look-ups that do not move the sets."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemart.functions import sets as S
from lakemart.operators import similarity
from lakemart.operators.corpus import build_corpus


def test_parities_never_exceed_what_differs():
    rng = random.Random(5)
    data = [set(), {-1}, {2**62, -(2**63)}] + [{rng.randrange(-(2**63), 2**63) for _ in range(rng.choice([3, 70, 300, 900]))} for _ in range(12)]
    data += [set(list(data[-1])[:-5]) | {1, 2}]
    fields = S.parities(pa.array([sorted(d) for d in data], pa.list_(pa.int64()))).to_pylist()
    for a, x in zip(data, fields):
        assert len(x) * 8 >= len(a) and S.distance(x, x) == 0
        for b, y in zip(data, fields):
            assert S.distance(x, y) == S.distance(y, x) <= len(a ^ b)
    assert S.distance(fields[-1], fields[-2]) >= 3 and S.distance(fields[-1], fields[3]) > 20


def test_sets_that_share_little_leave_no_rows(spark):
    """Only heads of sets are dealt out, not all shingles: a fifth of each set, and none without a partner of its size."""
    rng = random.Random(1)
    data = [(i, sorted({rng.randrange(2**62) for _ in range(100)} | set(range(i % 3)))) for i in range(60)]
    data += [(100, list(range(1000, 1100))), (101, list(range(1000, 1095))), (102, list(range(1000, 1050)))]
    sets = spark.createDataFrame([(g, len(s), s) for g, s in data], "group_id bigint, n_shingles int, shingles array<bigint>")
    rows = similarity.prefix_buckets(sets, 80)
    assert {r.group_id for r in rows.collect()} == {100, 101}
    assert [(r.group_a, r.group_b, r.shared) for r in similarity.similar_groups(sets, 80).collect()] == [(100, 101, 95)]


@pytest.mark.parametrize("text", ["one two three four"])
def test_looking_up_pairs_moves_no_sets(spark, text):
    corpus = build_corpus(spark.createDataFrame([(i, f"{text} {i // 2}") for i in range(40)], "doc_id bigint, text string"))
    pairs = spark.range(39).select(F.col("id").alias("group_a"), (F.col("id") + 1).alias("group_b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = similarity.verify(pairs, corpus.sets, 80)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert not any("FileScan" in below for below in lines[i + 1 : i + 4]), plan
