"""The growing index: same cards as re-runs, and a night reads only what it touches."""

import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators import clusters
from lakemart.operators.corpus import sketch
from lakemart.streaming import index as I
from lakemart.streaming import lines as L

SCHEMA = "doc_id bigint, text string"
BODY = " ".join(f"word{i}" for i in range(80))
NIGHTS = [
    [(4, BODY), (5, BODY + " x"), (9, "something else entirely here")],
    [(6, BODY), (7, BODY + " y"), (4, BODY), (1, "a notice of its own kind")],
    [(8, "Something ELSE, entirely here!"), (2, BODY + " x y"), (2, "twice")],
]


def as_of(n):
    return f"2024-01-{n + 1:02d} 00:00:00"


def mapping(store, batches):
    return {r.notice_id: r.card_id for r in I.cards_now(store, batches).collect()}


def test_nights_arrive_as_files(spark, tmp_path):
    store = I.DeltaStore(spark, str(tmp_path / "store"), ranges=16)
    for night in NIGHTS:
        spark.createDataFrame(night, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "inbox"))
        batches = I.run(L.file_stream(spark, str(tmp_path / "inbox"), SCHEMA), store, str(tmp_path / "progress"), 80, as_of)
    want = {**dict.fromkeys((2, 4, 5, 6, 7), "CARD-4"), 9: "CARD-9", 8: "CARD-9", 1: "CARD-1"}
    got = mapping(store, batches)
    assert batches == 3 and {k: v for k, v in got.items() if k != 2} == {k: v for k, v in want.items() if k != 2} and got[2] in ("CARD-4", "CARD-2")
    I.process_delta(store, spark.createDataFrame(NIGHTS[1], SCHEMA), 1, 80, as_of(1))  # a replayed batch
    assert mapping(store, 2) == {k: v for k, v in want.items() if k not in (8, 2)}
    I.process_delta(store, spark.createDataFrame([], SCHEMA), 3, 80, as_of(3))
    assert mapping(store, 4) == got


def test_a_bridge_merges_cards_and_chains_are_followed(spark, tmp_path):
    """Three texts that are alike only by way of others; each night's notice joins two cards."""
    words = [f"w{i}" for i in range(70)]
    steps = [" ".join(words[s : s + 50]) for s in (0, 4, 8, 12, 16)]
    store = I.DeltaStore(spark, str(tmp_path / "store"), ranges=4)
    nights = [[(30, steps[0]), (20, steps[2]), (10, steps[4])], [(40, steps[3])], [(50, steps[1])]]
    for n, night in enumerate(nights):
        I.process_delta(store, spark.createDataFrame(night, SCHEMA), n, 80, as_of(n))
    # Which neighbours share a bucket is up to the sketches; what is joined must be consistent.
    got = mapping(store, 3)
    led = {r.deprecated_card_id: r.active_card_id for r in I.redirects_now(store, 3).collect()}
    first = mapping(store, 1)
    assert first == {30: "CARD-30", 20: "CARD-20", 10: "CARD-10"}
    for notice, card in first.items():
        assert got[notice] == led.get(card, card)
    assert set(led.values()).isdisjoint(led)


def test_chains_of_parents_and_redirects(spark):
    pairs = [(i, i - 1) for i in range(1, 60)] + [(100, 7)]
    schema = "node bigint, parent bigint"
    got = {r.node: r.cluster for r in clusters.follow(spark.createDataFrame(pairs, schema), "node", "parent").collect()}
    assert got == {**{i: 0 for i in range(1, 60)}, 100: 0}
    assert clusters.follow(spark.createDataFrame([], schema), "node", "parent").collect() == []
    with pytest.raises(ValueError):
        clusters.follow(spark.createDataFrame([(1, 2), (2, 1), (5, 6)], schema), "node", "parent")


def test_the_third_night_reads_no_untouched_range(spark, tmp_path):
    rng = random.Random(3)
    store = I.DeltaStore(spark, str(tmp_path / "store"), ranges=64)

    def texts(ids):
        return spark.createDataFrame([(i, " ".join(f"t{rng.randrange(900)}" for _ in range(40))) for i in ids], SCHEMA)

    for n, ids in enumerate((range(0, 40), range(40, 80))):
        I.process_delta(store, texts(ids), n, 80, as_of(n))
    third = texts([80])
    bands = sketch(third).select(F.posexplode("bands").alias(*I.BUCKET), F.col("doc_id").alias("group_id"), "n_shingles")
    wanted = store.touched(bands, *I.BUCKET)
    assert 0 < len(wanted) <= 16
    probe = store.lookup("bands", 2, bands)
    plan = probe._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "bucket_hash" in line)
    assert "PartitionFilters" in scan and "range" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    def opened(df):
        return {int(r[0].split("range=")[1].split("/")[0]) for r in df.select(F.input_file_name()).distinct().collect()}

    read, every = opened(store.read("bands", 2, wanted)), opened(store.read("bands", 2))
    assert read <= set(wanted) and len(every) > 50
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    I.process_delta(store, third, 2, 80, as_of(2))
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    assert all(after[p] == t for p, t in before.items())  # nothing of earlier nights is written again
    assert all("batch=2" in p for p in set(after) - set(before))
