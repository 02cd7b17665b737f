"""Text, MinHash, exact similarity join, LSH, clusters and cards."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.functions import minhash as M
from lakemart.functions import text as X
from lakemart.operators import cards, clusters, corpus, lsh, similarity
from lakemart.operators.quantiles import exact_percentiles

PREAMBLE = "GOVERNMENT OF INDIA -- NATIONAL PROCUREMENT AGGREGATION SERVICE\nThis notice is published as received.\n"


def texts(spark, pairs):
    return spark.createDataFrame([(i, t, b) for i, (t, b) in enumerate(pairs)], "doc_id bigint, title string, body string")


def words_of(df, rules, joiner=" "):
    cleaned = X.cleaned(F.col("title"), F.col("body"), rules, joiner)
    return [r[1] for r in sorted(df.select("doc_id", X.tokens(cleaned)).collect())]


# --- text ----------------------------------------------------------------------------------------------

def test_boilerplate_goes_and_content_stays(spark):
    df = texts(spark, [
        ("e-Tender - Road repair", PREAMBLE + "Name of work: Repair of NH44\nDisclaimer: no liability\nat all"),
        ("Tender Notice: Corrigendum - Road", "NAME OF WORK: Road\nTender Reference Number: X/12\nEnd"),
        ("NIT for Bridge", PREAMBLE + "no work named here"),
        ("Bridge", "GENERAL INSTRUCTIONS TO BIDDERS\nread all\n====================\nsteel STANDARD TERMS AND CONDITIONS\nx\n--------------------\nok"),
        (None, None),
    ])
    assert words_of(df, X.STANDARD_RULES) == [
        "road repair name of work repair of nh44".split(), "corrigendum road name of work road end".split(), ["bridge"],
        ["bridge", "steel", "ok"], [],
    ]


def test_portal_references(spark):
    df = texts(spark, [("t", "see NPAS-2024-0001234 and Department of references TN-000412/2024 too")])
    assert words_of(df, X.STANDARD_RULES) == [["t", "see", "and", "of", "too"]]
    assert words_of(df, X.STRICT_RULES) == [["t", "see", "and", "department", "of", "references", "too"]]
    assert "2024" in words_of(df, X.BODY_RULES)[0]


def test_block_rules_stop_at_the_work_name(spark):
    df = texts(spark, [("t", "STANDARD TERMS AND CONDITIONS APPLICABLE TO ALL NOTICES a b\nName of work: c\nref-2024-1 d")])
    assert words_of(df, X.BLOCK_RULES, "\n") == [["t", "name", "of", "work", "c", "d"]]


def test_reference_line_may_take_the_next_line(spark):
    df = texts(spark, [("t", "Ref no:\nlost line\nkept line")])
    assert words_of(df, X.STANDARD_RULES) == [["t", "kept", "line"]]


@pytest.mark.parametrize("k,expected", [(1, {"a", "b"}), (2, {"a b", "b a"}), (3, {"a b a", "b a b"}), (5, {"a", "b"})])
def test_word_shingles(spark, k, expected):
    df = spark.createDataFrame([(["a", "b", "a", "b"],)], "w array<string>")
    assert set(df.select(X.word_shingles(F.col("w"), k)).first()[0]) == expected


def test_empty_and_short_texts(spark):
    df = texts(spark, [("", "")])
    row = df.select(X.word_shingles(X.tokens(F.col("body")), 3), X.char_shingles(F.col("body")), X.tokens(F.lit("Été_1 x"), X.UNICODE_WORD)).first()
    assert row[0] == [] and row[1] == [""] and row[2] == ["été_1", "x"]


def test_char_shingles_fold_space_and_keep_code_points(spark):
    df = texts(spark, [("", "Ab \n\t c😀defghi")])
    folded = "ab c😀defghi"
    assert set(df.select(X.char_shingles(F.col("body"), 9)).first()[0]) == {folded[i:i + 9] for i in range(len(folded) - 8)}


sets = st.lists(st.integers(0, 6), max_size=7, unique=True)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(sets, sets), min_size=1, max_size=20))
def test_jaccard_and_containment(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<int>, b array<int>")
    a, b = F.col("a"), F.col("b")
    for r in df.select("a", "b", X.jaccard(a, b), X.jaccard(b, a), X.jaccard(a, b, 1.0), X.containment(a, b)).collect():
        x, y = set(r[0]), set(r[1])
        want = len(x & y) / len(x | y) if x | y else 0.0
        assert r[2] == r[3] == want and r[4] == (want if x | y else 1.0)
        assert r[5] == (len(x & y) / min(len(x), len(y)) if x and y else 0.0)


# --- MinHash -------------------------------------------------------------------------------------------

def test_signatures_are_the_minima_in_every_block_split():
    coefs = M.coefficients(16)
    rng = np.random.default_rng(1)
    lengths = [0, 3, 0, 1, 70_000, 5, 66_000, 0, 2]
    data = [rng.integers(0, M.PRIME, n).tolist() for n in lengths]
    got = M.signatures(pa.array(data, pa.list_(pa.int64())), coefs)
    for row, values in zip(got, data):
        assert row.tolist() == [min(((h * a + b) % M.PRIME for h in values), default=0) for a, b in coefs]
    sliced = pa.array(data, pa.list_(pa.int64())).slice(3, 3)
    assert (M.signatures(sliced, coefs) == got[3:6]).all()


def test_estimate_is_within_its_error_bound(spark):
    rng = random.Random(3)
    rows, exact = [], []
    for i in range(300):
        shared, own = rng.randint(0, 60), rng.randint(1, 60)
        a = [f"{i}s{j}" for j in range(shared)] + [f"{i}a{j}" for j in range(own)]
        b = [f"{i}s{j}" for j in range(shared)] + [f"{i}b{j}" for j in range(own)]
        rows.append((i, a, b, shared / (shared + 2 * own)))
    df = spark.createDataFrame(rows, "i int, a array<string>, b array<string>, jaccard double")
    signed = df.select("jaccard", M.signature(M.shingle_hashes(F.col("a"))).alias("x"), M.signature(M.shingle_hashes(F.col("b"))).alias("y"))
    scored = signed.select("jaccard", M.estimated_jaccard(F.col("x"), F.col("y")).alias("estimate"))
    summary = lsh.error_summary(scored).first()
    assert summary.rmse < 0.0442 * 1.1 and abs(summary.bias) < 0.01
    assert sum(r.pairs for r in lsh.error_by_band(scored).collect()) == 300


def test_survival_probability(spark):
    row = spark.range(1).select(*[M.survival_probability(F.lit(s), 16, 8) for s in (0.1, 0.3, 0.75, 0.85)]).first()
    assert [round(v, 4) for v in row] == [0.0, 0.001, 0.8151, 0.9938]
    assert round(M.survival_threshold(16, 8), 3) == 0.707


def test_similarity_bands_count_every_pair_once(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.2, 0.5, 0.8, 1.0)], "j double")
    assert [r[0] for r in df.select(lsh.similarity_band(F.col("j"))).collect()] == [0.0, 0.2, 0.5, 0.8, 0.8]


# --- similarity join -----------------------------------------------------------------------------------

def groups_of(spark, shingle_sets):
    rows = [(i, 1, len(s), sorted(s)) for i, s in enumerate(shingle_sets)]
    return spark.createDataFrame(rows, "group_id bigint, n_docs bigint, n_shingles int, shingles array<bigint>")


def brute_force(shingle_sets, percent):
    found = set()
    for (i, a), (j, b) in itertools.combinations(enumerate(shingle_sets), 2):
        if a & b and len(a & b) * 100 >= percent * len(a | b):
            found.add((i, j))
    return found


def families(seed, n=60):
    """Sets around shared templates, so that every similarity occurs, with shingles that are in all of them."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = rng.choice([0, 100, 200])
        size = rng.randint(1, 40)
        s = {base + x for x in range(size)}
        s = {x for x in s if rng.random() > 0.12} | {rng.randint(1000, 1100) for _ in range(rng.randint(0, 4))} | {7}
        out.append(s)
    return out


@pytest.mark.parametrize("percent", [30, 50, 80, 95, 100])
@pytest.mark.parametrize("hot", [5000, 3])
def test_similarity_join_finds_what_brute_force_finds(spark, monkeypatch, percent, hot):
    monkeypatch.setattr(similarity, "HOT_SHINGLE", hot)
    data = families(percent)
    got = similarity.similar_groups(groups_of(spark, data), percent)
    assert {(r.group_a, r.group_b) for r in got.collect()} == brute_force(data, percent)
    assert all(r.jaccard == len(data[r.group_a] & data[r.group_b]) / len(data[r.group_a] | data[r.group_b]) for r in got.collect())


# --- corpus and LSH ------------------------------------------------------------------------------------

def document(rng, n=60):
    return " ".join(f"w{rng.randint(0, 500)}" for _ in range(n))


@pytest.fixture(scope="module")
def notices(spark):
    """A third of all notices are one text; one template has thirty near copies; the rest are alone or short."""
    rng = random.Random(11)
    template = document(rng, 120).split()
    out = ["the same old notice text again"] * 40
    for i in range(30):
        copy = list(template)
        copy[rng.randrange(len(copy))] = f"changed{i}"
        out.append(" ".join(copy))
    out += [document(rng) for _ in range(40)] + ["", "", "a b", "A  B!", "b a"]
    rng.shuffle(out)
    return spark.createDataFrame(list(enumerate(out)), "doc_id bigint, text string"), out


@pytest.fixture(scope="module")
def built(spark, notices):
    return corpus.build_corpus(notices[0])


def shingle_set(text, k=3):
    import re

    t = re.findall("[a-z0-9]+", text.lower())
    return frozenset(t) if len(t) < k else frozenset(" ".join(t[i:i + k]) for i in range(len(t) - k + 1))


def test_copies_are_one_group(built, notices):
    by_set = {}
    for i, t in enumerate(notices[1]):
        by_set.setdefault(shingle_set(t), []).append(i)
    want = {min(ids): len(ids) for ids in by_set.values()}
    assert {r.group_id: r.n_docs for r in built.groups.collect()} == want
    assert {r.doc_id: r.group_id for r in built.members.collect()} == {i: min(ids) for ids in by_set.values() for i in ids}


def true_pairs(documents, percent):
    s = [shingle_set(t) for t in documents]
    return {(i, j) for i, j in itertools.combinations(range(len(s)), 2) if s[i] and len(s[i] & s[j]) * 100 >= percent * len(s[i] | s[j])}


def test_compact_pairs_stand_for_all_pairs(built, notices):
    pairs = similarity.near_duplicates(built.groups, similarity.similar_groups(built.group_sets, 80))
    total = sum(r.doc_pairs for r in pairs.collect())
    assert total == len(true_pairs(notices[1], 80))
    assert pairs.count() < total / 1.5


@pytest.mark.parametrize("cap", [1, 2, 5, 1000])
def test_verified_pairs_do_not_depend_on_the_cap(built, cap):
    everything = {(r.group_a, r.group_b) for r in lsh.verified_pairs(built.groups, built.sets, 80, 10**9).collect()}
    assert {(r.group_a, r.group_b) for r in lsh.verified_pairs(built.groups, built.sets, 80, cap).collect()} == everything
    assert len(everything) > 100


def test_candidates_keep_large_buckets_as_buckets(built, notices):
    bands = lsh.band_rows(built.groups)
    docs = [(r.band_id, r.bucket_hash, r.doc_id) for r in lsh.notice_bands(bands, built.members).collect()]
    buckets = {}
    for band, bucket, doc in docs:
        buckets.setdefault((band, bucket), []).append(doc)
    small = {p for ids in buckets.values() if len(ids) <= 5 for p in itertools.combinations(sorted(ids), 2)}
    large = {(min(ids), d) for ids in buckets.values() if len(ids) > 5 for d in ids if d != min(ids)}
    got = lsh.candidate_pairs(bands, built.members, 5).collect()
    assert {(r.doc_a, r.doc_b) for r in got if r.kind == "pair"} == small
    assert {(r.doc_a, r.doc_b) for r in got if r.kind == "bucket"} == large and large


def test_load_and_recall(built, notices):
    bands = lsh.band_rows(built.groups)
    before = lsh.load_summary(lsh.candidate_load(bands), "b").first()
    after = lsh.load_summary(lsh.candidate_load(bands, 5), "a").first()
    assert before.notices == after.notices == len(notices[1])
    assert before.max >= 39 * 16 and after.max < before.max and after.total_comparisons < before.total_comparisons
    truth = similarity.near_duplicates(built.groups, similarity.similar_groups(built.group_sets, 80))
    free, capped = lsh.recall(truth, built.groups, None).first(), lsh.recall(truth, built.groups, 5).first()
    assert free.truth == capped.truth == len(true_pairs(notices[1], 80))
    assert 0.7 < free.recall <= 1.0 and capped.recall < free.recall


def test_cost_sweep(spark):
    scored = spark.createDataFrame([(0.9, "same"), (0.7, "same"), (0.75, "different"), (0.1, "different")], "estimate double, label string")
    sweep = lsh.cost_sweep(scored, (50, 80, 95))
    assert sorted((r.threshold_pct, r.false_merges, r.misses, r.cost) for r in sweep.collect()) == [(50, 1, 0, 100), (80, 0, 1, 1), (95, 0, 2, 2)]
    assert lsh.operating_point(sweep).first().threshold_pct == 80


# --- clusters ------------------------------------------------------------------------------------------

def union_find(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(50, i) for i in range(30)] + [(60, 61), (61, 62), (62, 60)],
    [(a, b) for a, b in zip(*[random.Random(s).sample(range(60), 40) for s in (1, 2)])],
])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "group_a bigint, group_b bigint")
    got = {r.node: r.cluster for r in clusters.components(df).collect()}
    assert got == union_find([e for e in edges if e[0] != e[1]])


def test_cluster_profile(spark, rows):
    df = spark.createDataFrame([(1, 1, 10, "x"), (2, 1, 11, "y"), (3, 1, 10, "z"), (4, 4, 5, "x")], "doc_id int, cluster_id int, v int, kind string")
    profile = clusters.cluster_profile(df, "v", "kind")
    assert rows(profile) == [(1, 1, 1, 0, 0, 0), (3, 1, 3, 3, 1, 1)]
    base = clusters.base_rate(profile).first()
    assert (base.notices, base.duplicate_pairs, base.base_rate) == (4, 3, 0.5)
    assert rows(clusters.larger_clusters(df), "doc_id") == [(1,), (2,), (3,)]
    assert [tuple(r) for r in clusters.value_counts(df, "kind").collect()] == [("x", 2), ("y", 1), ("z", 1)]


# --- cards ---------------------------------------------------------------------------------------------

def night(spark, state, found, day):
    df = spark.createDataFrame([(n, c) for c, members in found.items() for n in members], "notice_id bigint, cluster_id bigint")
    return cards.update_cards(state, df, f"2024-01-{day:02d} 00:00:00").durable()


def mapping(state):
    return {r.notice_id: r.card_id for r in state.mapping.collect()}


def test_absorption_keeps_the_card(spark):
    state = night(spark, cards.empty_state(spark), {4: [4, 5]}, 1)
    state = night(spark, state, {4: [4, 5, 6, 7, 8]}, 2)
    bookmark = spark.createDataFrame([("CARD-4",)], "card_id string")
    assert tuple(cards.resolve(state, bookmark).first()) == ("CARD-4", "CARD-4", 4, 5)
    card = state.cards.first()
    assert card.created_at < card.updated_at and state.redirects.count() == 0


def test_merges_redirect_to_the_oldest_and_chains_are_cut(spark, rows):
    state = night(spark, cards.empty_state(spark), {9: [9], 1: [1, 2]}, 1)
    state = night(spark, state, {9: [9], 1: [1, 2], 5: [5]}, 2)
    state = night(spark, state, {5: [5, 9], 1: [1, 2]}, 3)
    assert rows(state.redirects, "deprecated_card_id", "active_card_id") == [("CARD-5", "CARD-9")]
    state = night(spark, state, {1: [1, 2, 5, 9]}, 4)
    assert rows(state.redirects, "deprecated_card_id", "active_card_id") == [("CARD-5", "CARD-1"), ("CARD-9", "CARD-1")]
    assert set(mapping(state).values()) == {"CARD-1"}
    assert rows(state.cards, "card_id") == [("CARD-1",)]


def test_split_stays_with_the_canonical_notice(spark):
    state = night(spark, cards.empty_state(spark), {1: [1, 2, 3]}, 1)
    state = night(spark, state, {1: [1], 2: [2, 3]}, 2)
    assert mapping(state) == {1: "CARD-1", 2: "CARD-2", 3: "CARD-2"}


def test_an_old_card_id_is_not_given_out_again(spark):
    state = night(spark, cards.empty_state(spark), {1: [1], 2: [2]}, 1)
    state = night(spark, state, {1: [1, 2]}, 2)
    state = night(spark, state, {1: [1], 2: [2]}, 3)
    assert mapping(state) == {1: "CARD-1", 2: "CARD-2-20240103"}


def test_unseen_notices_keep_their_card(spark):
    state = night(spark, cards.empty_state(spark), {1: [1, 2], 5: [5]}, 1)
    state = night(spark, state, {5: [5, 6]}, 2)
    assert mapping(state) == {1: "CARD-1", 2: "CARD-1", 5: "CARD-5", 6: "CARD-5"}


def test_stability_under_random_growth(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(18)]
    state, issued = cards.empty_state(spark), set()
    for day, (n, e) in enumerate([(12, 5), (22, 11), (30, 18)], start=1):
        here = [x for x in edges[:e] if max(x) < n]
        root = union_find(here + [(i, i) for i in range(n)])
        found = {}
        for i in range(n):
            found.setdefault(root[i], []).append(i)
        state = night(spark, state, found, day)
        issued |= {(c, i) for i, c in mapping(state).items()}
    report = cards.stability(spark.createDataFrame(list(issued), "card_id string, notice_id bigint"), state).first()
    assert report.issued == report.resolved == len({c for c, _ in issued}) and report.broken == report.lost_notices == 0
    held = {}
    for i, c in mapping(state).items():
        held.setdefault(c, set()).add(i)
    groups = {}
    for i in range(30):
        groups.setdefault(root[i], set()).add(i)
    assert sorted(map(sorted, held.values())) == sorted(map(sorted, groups.values()))


def test_exact_percentiles(spark):
    rng = random.Random(2)
    data = {k: [rng.randint(0, 20) for _ in range(n)] for k, n in (("a", 1), ("b", 40), ("c", 101))}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v int")
    got = exact_percentiles(df, ["k"], "v", {"p10": 0.1, "p50": 0.5, "p95": 0.95})
    for r in got.collect():
        assert [r.p10, r.p50, r.p95] == pytest.approx(np.percentile(data[r.k], [10, 50, 95]).tolist())
        assert (r["count"], r.minimum, r.maximum) == (len(data[r.k]), min(data[r.k]), max(data[r.k]))
