import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lakemart.llm import ngram_join
from lakemart.llm.ngram_join import Bands, near_duplicates

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        met = defaultdict(int)
        for x in s:
            for j in holders[x]:
                met[j] += 1
            holders[x].append(i)
        for j, common in met.items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids, default=None)) for i in members]
    return sorted(out, key=str)


def family(seed, sizes=(3, 8, 12, 20, 45, 120, 400), copies=12):
    rng, rows = random.Random(seed), []
    for n in sizes:
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + max(1, n // 25))):
                at = rng.randrange(len(words))
                if rng.random() < 0.4:
                    words.insert(at, f"v{rng.randrange(5000)}")
                elif rng.random() < 0.5 and len(words) > 1:
                    del words[at]
                else:
                    words[at] = f"v{rng.randrange(5000)}"
            rows.append((len(rows) * 3 + seed, " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent,seed", [(4, 85, 1), (5, 80, 2), (4, 85, 3), (1, 80, 4)])
def test_components_equal_brute_force(spark, rows, k, percent, seed):
    made = family(seed) + [
        (100001, None), (100002, ""), (100003, " \n\t"), (100004, "one"), (100005, "ONE"), (100006, "one two"), (100006, "one two"),
        (None, "one two"), (100007, "É é"), (100008, "é É"), (None, "lonely words of no one else here"), (100009, "tick " * 3000),
        (100010, "tick " * 2999),
    ]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in made], "doc_id long, text string, sig int, n int").repartition(5)
    assert rows(near_duplicates(docs, k, percent)) == brute(made, k, percent)


def test_whole_table_equals_brute_force(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(near_duplicates(docs, 4, 85)) == brute(texts, 4, 85)


def test_bands_leave_enough_segments():
    for percent in (80, 85, 90):
        bands = Bands(percent)
        for top, spare, segments in zip(bands.tops[:40].tolist(), bands.spare.tolist(), bands.segments.tolist()):
            differ = 2 * top * (100 - percent) // (100 + percent)
            assert segments == 0 if not differ else segments - differ == spare + 1


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_each_class_fetches_one_text(spark, rows, monkeypatch):
    """Rows that share an id, or have none, do not meet each other's texts."""
    made = [(i, " ".join(f"{k}w{j}" for j in range(30)) + tail) for k in range(60) for i, tail in ((None, ""), (None, " end"), (4, " or so"))]
    seen, fetch = [], ngram_join.class_texts

    def watched(docs, classes, involved):
        seen.append((fetch(docs, classes, involved).collect(), involved.count()))
        return fetch(docs, classes, involved)

    monkeypatch.setattr(ngram_join, "class_texts", watched)
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    assert rows(near_duplicates(docs, 4, 85)) == brute(made, 4, 85)
    (texts, involved), = seen
    assert len(texts) == involved == len(made) and {r.text for r in texts} == {t for _, t in made}


def test_sketches_are_short_and_tell_unrelated_sets_apart():
    rng = np.random.default_rng(3)
    for n in (64, 100, 1000, 5000):
        a, b = (rng.integers(0, 1 << 63, n, np.uint64) for _ in range(2))
        assert 8 * len(ngram_join.parity_sketch(a)) <= 2 * n
        assert not ngram_join.may_link(n, n, ngram_join.parity_sketch(a), ngram_join.parity_sketch(b), 80)


def test_settled_buckets_are_not_compared_again(spark, rows, monkeypatch):
    """Buckets in which the first comparison left nothing out, and those of two, do not go through another one."""
    made = family(7, sizes=(120,), copies=3) + [(900 + i, " ".join(f"{i}x{j}" for j in range(60)) + " ends alike for all") for i in range(40)]
    sizes, write = [], ngram_join.durable

    def watched(df, label):
        table = write(df, label)
        if label in ("buckets", "bucket-members"):
            sizes.append((label, table.count()))
        return table

    monkeypatch.setattr(ngram_join, "durable", watched)
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    assert rows(near_duplicates(docs, 1, 80)) == brute(made, 1, 80)
    assert [n > 0 for _, n in sizes] == [True, True, False]
