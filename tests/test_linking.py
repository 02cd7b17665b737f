"""Clusters without all pairs, and buckets in blocks."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators import clusters, linking, lsh, similarity
from lakemart.operators.corpus import build_corpus
from lakemart.plans import notices as N
from test_notices import brute_force, families, groups_of, union_find


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_every_pair_of_a_bucket_once(spark, block):
    rng = random.Random(block)
    rows = {(rng.choice("abbb"), rng.randrange(60)) for _ in range(90)}
    df = spark.createDataFrame([(b, g, g * 2) for b, g in rows], "bucket string, group_id bigint, v bigint")
    got = [(r.bucket, *sorted((r.x.group_id, r.y.group_id))) for r in linking.bucket_pairs(df, ["bucket"], block).collect()]
    want = {(b, *p) for b in "ab" for p in itertools.combinations(sorted(g for k, g in rows if k == b), 2)}
    assert len(got) == len(set(got)) and set(got) == want


def test_a_hot_bucket_is_spread(spark):
    """One bucket with half of all rows: no join key holds more than its share."""
    df = spark.range(4000).select(F.when(F.col("id") < 2000, F.lit(-1)).otherwise(F.col("id") % 500).alias("bucket"), F.col("id").alias("group_id"))
    plan = linking.bucket_pairs(df, ["bucket"], 100)
    assert plan.count() == 2000 * 1999 // 2 + 500 * 6
    sizes = df.groupBy("bucket").agg(F.ceil(F.count("*") / 100).alias("b"))
    own = df.join(sizes, "bucket").groupBy("bucket", F.pmod(F.xxhash64("group_id"), "b").alias("i")).count()
    assert own.agg(F.max("count")).first()[0] < 200


@pytest.mark.parametrize("percent", [30, 50, 80, 100])
@pytest.mark.parametrize("block", [2, 512])
def test_clusters_are_those_of_all_pairs(spark, percent, block):
    data = families(percent + 1)
    sets = groups_of(spark, data)
    links = linking.connect(similarity.prefix_buckets(sets, percent), sets, percent, ["shingle"], block=block)
    found = {(r.group_a, r.group_b) for r in links.collect()}
    truth = brute_force(data, percent)
    assert found <= truth and union_find(found) == union_find(truth)
    assert {r.node: r.cluster for r in clusters.components(links).collect()} == union_find(truth)


@pytest.mark.parametrize("percent", [40, 80])
def test_growing_in_nights(spark, percent):
    data = families(percent)
    truth = brute_force(data, percent)
    sets = groups_of(spark, data)
    buckets = similarity.prefix_buckets(sets, percent)
    labels, seen = None, 0
    for upto in (20, 21, 60):
        rows = buckets.where(F.col("group_id") < upto).withColumn("is_new", F.col("group_id") >= seen)
        links = linking.connect(rows, sets, percent, ["shingle"], labels)
        got = links.collect()
        assert all(max(r.group_a, r.group_b) >= seen for r in got)  # two old groups are settled
        joined = {r.node: r.cluster for r in clusters.components(links, "from_a", "from_b").collect()}
        before = {} if labels is None else {r.node: r.cluster for r in labels.collect()}
        now = {g: joined.get(before.get(g, g), before.get(g, g)) for g in range(upto)}
        want = union_find({p for p in truth if max(p) < upto})
        assert now == {g: want.get(g, g) for g in range(upto)}
        labels, seen = spark.createDataFrame(list(now.items()), "node bigint, cluster bigint"), upto


def test_a_large_family_takes_few_links(spark):
    words = [f"w{i}" for i in range(120)]
    n = 5000
    texts = [" ".join([*words[: i % 100], f"own{i}", *words[i % 100 :]]) for i in range(n)]
    notices = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    run = N.run_notices(notices)
    assert run.links.count() < 3 * n
    assert run.clusters.select("cluster_id").distinct().count() == 1
    exact = N.exact_clusters(run.corpus)
    assert exact.where("cluster_id = 0").count() == n


def test_dissimilar_groups_in_one_bucket(spark):
    """A bucket of groups that share little: nothing links, and the work ends."""
    data = [{1, 2, 3} | {100 * i + j for j in range(20)} for i in range(1, 80)] + [set()]
    sets = groups_of(spark, data)
    rows = sets.select(F.lit(1).alias("bucket"), "group_id", "n_shingles")
    assert linking.connect(rows, sets, 80, ["bucket"], block=8).collect() == []
    assert linking.connect(rows.limit(0), sets, 80, ["bucket"]).collect() == []


def test_verified_pairs_of_a_corpus(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(3)) for _ in range(30)) for _ in range(40)]
    texts += [t + " tail" for t in texts[:20]]
    corpus = build_corpus(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    plan = lsh.verified_pairs(corpus.groups, corpus.sets, 80)
    got = [(r.group_a, r.group_b) for r in plan.collect()]
    assert len(got) == len(set(got)) > 15
    assert all(b - a == 40 for a, b in got)
