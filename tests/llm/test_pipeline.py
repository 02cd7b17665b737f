import sys
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm import mixing, toxicity

sys.path.append(__file__.rpartition("/")[0])

import test_line_dedup  # noqa: E402
import test_mixing  # noqa: E402
import test_ngram_join  # noqa: E402

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_brute_force_one_after_the_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*COLUMNS)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        out = stage[name](spark, docs, FOLDER)
        if name != "packing":
            assert sorted(out.columns) == sorted(COLUMNS)
        return out, [tuple(r) for r in out.select(*COLUMNS).collect()] if name != "packing" else out.collect()

    before = [tuple(r) for r in docs.collect()]
    out, after = run("toxicity", docs)
    model = toxicity.fit(docs, labels)
    tops, hits = zip(*(model.features(r[1]) for r in before))
    import numpy as np

    p = model.probability(np.array(tops), np.array(hits))
    assert Counter(after) == Counter(r for r, x in zip(before, p) if x < 0.5)

    kept = spark.createDataFrame(after, docs.schema)
    _, after2 = run("line dedup", kept)
    want = test_line_dedup.brute([(r[0], r[1]) for r in after])
    expect = [(r[0], want[r[0], r[1]][0], *r[2:4], len(want[r[0], r[1]][0] or "")) for r in after]
    expect = [e for e, r in zip(expect, after) if want[r[0], r[1]][2] == 0 or (e[1] or "").split() or not (r[1] or "").split()]
    assert Counter(after2) == Counter(expect)

    _, after3 = run("n-gram Jaccard join", spark.createDataFrame(after2, docs.schema))
    groups = {d: c for d, _, c in test_ngram_join.brute([(r[0], r[1]) for r in after2], 5, 80)}
    assert Counter(after3) == Counter(r for r in after2 if groups[r[0]] == r[0])

    out4, after4 = run("mixing", spark.createDataFrame(after3, docs.schema))
    chosen = test_mixing.brute([r[:4] for r in after3], mixing.SHARE_PERCENT, mixing.MAX_EPOCHS, mixing.SEED, mixing.WEIGHTS)
    assert Counter(r[0] for r in after4) == Counter(c[0] for c in chosen)

    _, pieces = run("packing", spark.createDataFrame(after4, docs.schema))
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = Counter()
    for r in after4:
        sizes[r[0]] += len(plain.encode(r[1] or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in pieces:
        got[r.doc_id] += r.length
    assert got == sizes


def test_run_gives_pieces_of_full_sequences(spark):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    fill = Counter()
    for r in pieces:
        fill[r.sequence_id] += r.length
    assert all(n == 2048 for s, n in fill.items() if s != max(fill)) and sorted(fill) == list(range(len(fill)))


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, null ids, and one id with texts of two groups."""
    long = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcde"]
    near = [t + " more" for t in long]
    made = [
        (5, long[0], "en", "x", 1), (5, long[0], "en", "x", 1), (9, near[0], "en", "x", 1), (None, long[0], "en", "x", 1), (None, near[0], "en", "x", 1),
        (None, long[1], "en", "x", 1), (None, long[1], "en", "x", 1), (None, near[1], "en", "x", 1),
        (3, long[2], "en", "x", 1), (3, near[3], "en", "x", 1), (1, near[2], "en", "x", 1), (7, long[3], "en", "x", 1),
        (8, long[4], "en", "b", 1), (8, long[4], "en", "a", 1), (8, long[4], None, "c", 1),
        (None, "one of its own", "en", "x", 1), (20, "", "en", "x", 1), (20, "", "en", "x", 1), (20, " ", "en", "x", 1), (21, None, "en", "x", 1),
        (None, "\n", "en", "x", 1), (None, "\n", "en", "x", 1), (None, None, "en", "x", 1),
    ]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = Counter(tuple(r) for r in dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, FOLDER).collect())
    unnamed = [(r, n) for r, n in got.items() if r[0] is None and r[1] in (long[1], near[1])]
    assert [n for _, n in unnamed] == [1]
    assert got - Counter([unnamed[0][0]]) == Counter([
        made[0], (3, near[3], "en", "x", 1), (1, near[2], "en", "x", 1), (8, long[4], None, "c", 1),
        (None, "one of its own", "en", "x", 1), (20, "", "en", "x", 1), (20, " ", "en", "x", 1), (21, None, "en", "x", 1),
        (None, "\n", "en", "x", 1), (None, "\n", "en", "x", 1), (None, None, "en", "x", 1),
    ])
