import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest

from lakemart.llm import toxicity
from lakemart.llm.queries import op8_toxicity

FOLDER = "/root/testdata/sf0.1"


def auc(y, s):
    rank = s.rank()
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.fit(docs, labels)


def test_held_out_accuracy(spark):
    got = op8_toxicity(spark, FOLDER).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"] and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()
    both = got.merge(pd.read_parquet(f"{FOLDER}/labels.parquet"), on="doc_id")
    both = both[both.held_out & both.toxic.isin([0, 1])]
    assert auc(both.toxic, both.score) >= 0.95 and (both.predicted == both.toxic).mean() >= 0.95


def test_bent_words_are_nearer_than_others(model):
    plain = model.margins("the thanereou ofonly eranble whouereth").max()
    for word in ("i d i o t", "i.d.i.o.t", "st-upid", "SCUM", "stuupid", "morron", "idxiot", "losxer"):
        assert model.margins(word).max() > plain, word


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "1 2 3"), (None, "stupid idiot scum moron trash"), (6, "a b"), (6, "a b"), (7, "the " * 300_000 + "idiot scum moron loser")]
    docs = spark.createDataFrame([(d, t, 1.0, 1) for d, t in rows], "doc_id long, text string, score double, toxicity int")
    got = [(r.doc_id, r.score, round(r.toxicity, 6), r.toxic_words) for r in toxicity.score(docs, model).collect()]
    by = {g[0]: g for g in got}
    assert len(got) == len(rows) and all(g[1] == 1.0 for g in got)
    assert by[1][2] == by[2][2] == by[3][2] == by[4][2] < 0.5 and by[None][2] >= 0.5 and by[7][2] >= 0.5 and by[7][3] >= 2


def test_pieces_of_a_long_text_are_read_like_one(model, monkeypatch):
    text = "some words idiot and more scum " * 40
    whole = model.features(text)
    monkeypatch.setattr(toxicity, "PIECE_CHARS", 64)
    assert model.features(text) == whole


def test_tables_without_labels(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7)], "doc_id long, toxic int")
    for labels in (none, one):
        model = toxicity.fit(docs, labels)
        assert toxicity.score(docs, model).where("toxicity between 0 and 1").count() == 2
        assert toxicity.score(docs.limit(0), model).count() == 0


def test_weights_equal_the_kernel():
    """The folded table scores a word as the kernel with the landmarks does."""
    rng = np.random.default_rng(1)
    marks = [bytes([0, *rng.integers(1, 27, 6), 0]) for _ in range(5)]
    weights = np.zeros(toxicity._SLOTS, np.float32)
    alpha = rng.standard_normal(5)
    for a, m in zip(alpha, marks):
        slots, values = toxicity._subsequences(m)
        np.add.at(weights, slots, a * values)
    codes, sizes = toxicity.word_symbols("abcdef xyabz qq longer words")
    sums = toxicity.kernel_sums(codes, sizes, weights)
    ends = np.cumsum(sizes)
    for k, (e, s) in enumerate(zip(ends, sizes)):
        word = codes[e - s : e].tobytes()
        if s < 5:
            continue
        own = dict(zip(*[x.tolist() for x in _summed(word)]))
        want = sum(a * sum(v * own.get(c, 0) for c, v in zip(*[x.tolist() for x in _summed(m)])) for a, m in zip(alpha, marks))
        assert abs(want - sums[k]) < 1e-5


def _summed(word):
    slots, values = toxicity._subsequences(word)
    used, place = np.unique(slots, return_inverse=True)
    return used, np.bincount(place, values)


def test_sample_is_drawn_among_texts_that_can_be_learnt_from(spark, monkeypatch):
    """Over-long texts leave their place to others, and repeated rows do not take more than one."""
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, shares, **bounds: seen.append((texts, toxic.tolist(), bounds)))
    made = [(i, f"text {i}" if i % 3 else "x" * (toxicity.SAMPLE_CHARS + 1)) for i in range(300)]
    docs = spark.createDataFrame(made + made[100:200] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] * 2, "doc_id long, toxic int")
    toxicity.fit(docs, labels, sample=40, negatives=7, hard_negatives=5, landmark_pool=3)
    (texts, toxic, bounds), = seen
    assert len(set(texts)) == len(texts) == 80 and sum(toxic) == 40 and max(map(len, texts)) < 20
    assert bounds == {"negatives": 7, "hard_negatives": 5, "landmark_pool": 3}


def test_driver_holds_little_while_it_trains():
    """Arrays of words by landmarks are held once, and not in double precision."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    vocabulary = ["".join(rng.choice(letters, rng.integers(6, 13))) for _ in range(14_000)]
    bad, plain = vocabulary[:200], vocabulary[200:]
    toxic = np.arange(1200) % 2
    texts = [" ".join([*rng.choice(plain, 60), *rng.choice(bad, 4 * y)]) for y in toxic.tolist()]
    tracemalloc.start()
    try:
        model = toxicity.train(texts, toxic, (1.0, 1.0))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert (model.weights != 0).any()
    assert peak < 80, peak


def test_driver_handles_few_tasks_for_a_sample(spark):
    """Neither the count of labels nor the order of the sample deals rows over all shuffle partitions."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    sc = spark.sparkContext
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sc.setJobGroup("toxicity-sample", "fit")
        toxicity.fit(docs, labels, sample=20)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup("toxicity-sample") for s in status.getJobInfo(j).stageIds}
    tasks = [i.numCompletedTasks for i in map(status.getStageInfo, stages) if i]
    assert 0 < sum(n >= 40 for n in tasks) <= 5, sorted(tasks)
