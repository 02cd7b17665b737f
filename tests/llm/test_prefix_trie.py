import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lakemart.llm.prefix_trie import build_trie, turn_rows, with_texts
from lakemart.llm.queries import conversation_trie, op11_prefix_trie


def words(text):
    return sum(1 for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w)


def rebuilt(rows):
    """conv_id to its rebuilt turns; rows are (conv_id, turn, role, text), turns of one number equal."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs, nodes = rebuilt(rows), {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in nodes:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = sum(saved[k] for k in below) + (len(nodes[node]) - 1) * (words(node[-1][1]) if node else 0)
    out = []
    for node, in_it in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in in_it if len(convs[c]) == len(node)))
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(in_it), len(node), parent, len(in_it), len(kids.get(node, [])), leaves[node], saved[node], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def results(df):
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, rows, parts=3):
    schema = "conv_id long, turn long, role string, text string, place int, rep int, words string"
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], schema).repartition(parts)


def some_conversations():
    rows = []
    for c in range(90):
        for t in range((c * 7) % 6 + 1):
            shared = t < c % 5
            rows.append((c, t, ["user", "bot"][t % 2], f"turn {t}" if shared else f"turn {t} of {c % 11}"))
    for c in range(100, 160):  # a third of all are copies of one long conversation
        rows += [(c, t, "user", "the same long  thing " + "x" * (t % 3)) for t in range(30)]
    for c in range(160, 166):  # and some leave it late
        rows += [(c, t, "user", "the same long  thing " + "x" * (t % 3)) for t in range(25)] + [(c, 40, "bot", f"own {c}")]
    rows += [(200, None, "user", "null first"), (200, 0, None, None), (200, 1, "", ""), (210, 5, "user", None), (211, 1, "a", "one"), (None, 1, "user", "of none")]
    rows += [(220, 1, "user", "twice"), (220, 1, "user", "twice"), (221, 3, "user", "\t a  b\n")]
    return rows


@pytest.mark.parametrize("burst_at", [1, 40, 1 << 14])
def test_equals_brute_force(spark, burst_at):
    rows = some_conversations()
    assert results(conversation_trie(table(spark, rows), burst_at)) == brute(rows)


def test_empty_turnless_and_single(spark):
    assert results(conversation_trie(table(spark, []))) == []
    only = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)  # loses all it has
    rows = [(only, 0, "user", "gone")]
    assert rebuilt(rows) == {only: []} and results(conversation_trie(table(spark, rows))) == brute(rows)
    rows = [(20, 0, "user", "stays here"), (20, 1, "bot", "too")]
    assert results(conversation_trie(table(spark, rows))) == brute(rows)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(op11_prefix_trie(spark, "/root/testdata/sf0.01")) == brute(rows)


@pytest.mark.parametrize("burst_at", [3, 1 << 14])
def test_nodes_carry_their_turn(spark, burst_at):
    rows = some_conversations()
    source = table(spark, rows)
    turns = turn_rows(source)
    trie = build_trie(turns, turns.select("conv_id").distinct(), burst_at)
    got = with_texts(trie.nodes, source).collect()
    plain = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        plain.setdefault(c, []).append((role or "", text or ""))
    want = {tuple(p[:d]) for p in plain.values() for d in range(len(p) + 1)}
    assert len(got) == len(want)
    for r in got:
        assert (r.role, r.text) == (plain[r.conv_id][r.depth - 1] if r.depth else (None, None))
    ends = {r.class_id for r in got if r.class_id is not None}
    assert ends == {r.class_id for r in trie.members.select("class_id").distinct().collect()}


def test_a_shared_run_takes_one_round(spark):
    rows = [(c, t, "u", f"common {t}") for c in range(0, 400, 20) for t in range(60)] + [(c, 90, "u", f"own {c}") for c in range(0, 400, 20)]
    from lakemart.llm import prefix_trie as P

    seen = []
    original = P.durable_observed

    def counted(df, label, *metrics):
        seen.append(label)
        return original(df, label, *metrics)

    P.durable_observed = counted
    try:
        got = results(conversation_trie(table(spark, rows), 100))
    finally:
        P.durable_observed = original
    assert got == brute(rows) and seen == ["trie-bursting"] * 2
