from collections import defaultdict
from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from lakemart.llm import mixing
from lakemart.llm.mixing import mix_sources


def share_out(budget, children):
    """``{name: (weight, capacity)}`` to shares: fill what fills up first, then divide what is left."""
    got, left, rest = {}, sum(w for w, _ in children.values()), budget
    queue = sorted(children, key=lambda c: (float(children[c][1]) / float(children[c][0]), c is not None, c or ""))
    while queue:
        w, cap = children[queue[0]]
        if rest * w < cap * left:
            break
        got[queue.pop(0)] = cap
        rest, left = rest - cap, left - w
    return got | {c: int(Fraction(rest * children[c][0], left)) for c in queue}


def brute(rows, share, epochs, seed, weights):
    docs = []
    for doc_id, text, lang, source in rows:
        n = len([w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w])
        domain = next((d for d, s in mixing.DOMAINS.items() if source in s), mixing.OTHER_DOMAIN)
        if n:
            docs.append((doc_id, n, (domain, lang, source), text))
    tokens = defaultdict(int)
    for _, n, leaf, _ in docs:
        tokens[leaf] += n

    def cap(prefix):
        return sum(t * epochs for leaf, t in tokens.items() if leaf[: len(prefix)] == prefix)

    budgets = {(): min(sum(tokens.values()) * share // 100, cap(()))}
    for depth in range(3):
        new = {}
        for parent, budget in budgets.items():
            names = {leaf[depth] for leaf in tokens if leaf[:depth] == parent}
            kids = {c: (weights[depth].get(c, 1), cap((*parent, c))) for c in names}
            new |= {(*parent, c): b for c, b in share_out(budget, kids).items()}
        budgets = new
    out = []
    for leaf, budget in budgets.items():
        whole, rest = divmod(budget, tokens[leaf])
        own = [(i, n, t) for i, n, x, t in docs if x == leaf]
        out += [(i, *leaf, e, n, n) for e in range(whole) for i, n, _ in own]
        groups = defaultdict(list)
        for i, n, t in own:
            name = i if i is not None else "null:" + md5(t.encode()).hexdigest()
            groups[md5(f"{seed}:{whole}:{name}".encode()).hexdigest()].append((i, n))
        at = 0
        for key in sorted(groups):
            if at >= rest:
                break
            held = sum(n for _, n in groups[key])
            parts = [(i, n, min(n, n * (rest - at) // held)) for i, n in groups[key]]
            out += [(i, *leaf, whole, n, take) for i, n, take in parts if take]
            at += held
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, text string, lang string, source string, key string, n long").repartition(3)


@pytest.mark.parametrize("share,epochs,ranges", [(80, 4, 20_000), (150, 2, 7), (30, 1, 3), (900, 3, 5), (100, 4, 1)])
def test_equal_to_brute_force(spark, rows, monkeypatch, share, epochs, ranges):
    monkeypatch.setattr(mixing, "RANGE_ROWS", ranges)
    made = []
    for i in range(300):
        source = "src0" if i % 3 == 0 else f"src{i % 13}" if i % 50 else None
        made.append((i, "w " * (1 + i * 37 % 90), ["en", "en", "de", "fr", None, "xx"][i % 6], source))
    made += [(900, None, "en", "src0"), (901, "", "en", "src0"), (902, " \n", "en", "src1"), (None, "a b", "en", "src0"), (7, "again", "en", "src7"), (7, "again", "en", "src7")]
    got = mix_sources(table(spark, made), share, max_epochs=epochs)
    assert rows(got, "doc_id", "domain", "lang", "source", "epoch", "n_tokens", "take_tokens") == brute(made, share, epochs, mixing.SEED, mixing.WEIGHTS)
    assert set(got.columns) >= {"key", "n", "text"}


def test_rows_without_id_keep_the_budget(spark):
    made = [(i if i % 2 else None, f"{i} b c d e f g h i j", "en", "src0") for i in range(1000)]
    made += [(None, "one text for many", "en", "src77")] * 400
    got = mix_sources(table(spark, made), 50, max_epochs=1).groupBy("source").sum("take_tokens")
    # 5,800 tokens by 3 to 1; 400 copies share one place, so each of them takes 1,450 * 4 // 1,600 tokens
    assert dict(got.collect()) == {"src0": 4350, "src77": 1200}


def test_clashing_columns(spark, rows):
    made = [(i, "w " * (1 + i % 7), "en", f"src{i % 3}") for i in range(60)]
    plain = table(spark, made)
    named = plain
    for name in ("whole", "last_key", "last_take", "rest", "part", "at", "n", "budget", "tokens", "weight", "held", "before"):
        named = named.withColumn(name, F.lit(name))
    picked = ("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "take_tokens")
    got = mix_sources(named)
    assert rows(got, *picked) == rows(mix_sources(plain), *picked)
    assert got.select("whole", "last_key", "held").distinct().collect() == [("whole", "last_key", "held")]


def test_empty_tables(spark):
    assert mix_sources(table(spark, [(1, "x", "en", "a")]).limit(0)).count() == 0
    assert mix_sources(table(spark, [(1, None, "en", "a"), (2, "", None, None)])).count() == 0
