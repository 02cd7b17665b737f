import random

from lakemart.llm.line_dedup import later_starts, remove_repeated_lines


def brute(rows):
    """Texts keyed by (id, text): what is left of each when later windows of three lines go."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out[doc_id, text] = (None, 0, 0)
            continue
        lines = text.split("\n")
        solid = [(i, x.strip(" \t\r\f\x0b")) for i, x in enumerate(lines) if x.strip(" \t\r\f\x0b")]
        gone = set()
        for j in range(len(solid) - 2):
            window = tuple(x for _, x in solid[j : j + 3])
            if window in seen:
                gone.update(range(solid[j][0], solid[j + 2][0] + 1))
            seen.add(window)
        out[doc_id, text] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines) - len(gone), len(gone))
    return out


def test_equal_to_brute_force(spark):
    rng = random.Random(3)
    passage = [f"passage line {i}" for i in range(6)]
    made = [(None, "p\nq\nr\ns"), (1, None), (2, ""), (3, "a\nb"), (4, "\n\n\n\n"), (5, "a\na\na\na\na"), (7, "long line " * 5000)]
    for d in range(10, 90):
        lines = [f"line {rng.randrange(60)}" + rng.choice(["", " ", "\r"]) for _ in range(rng.randrange(1, 30))]
        at = rng.randrange(len(lines) + 1)
        made.append((d, "\n".join(lines[:at] + (passage if rng.random() < 0.5 else [""]) + lines[at:])))
    made += [(d + 100, t) for d, t in made[20:40]] + [made[30]]
    docs = spark.createDataFrame([(d, t, "x", 4) for d, t in made], "doc_id long, text string, lang string, j int").repartition(4)
    got = remove_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", "lang", "j", "n_lines", "n_removed"]
    want = brute(made)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=str) == sorted(
        ((d, *want[d, t]) for d, t in made), key=str
    )


def test_empty_table(spark):
    assert remove_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows_give_each_window_once(spark):
    text = "\n".join(f"line {i}" for i in range(8))
    made = [(1, text)] + [(2, text)] * 50 + [(None, "a\nb\nc")] * 40 + [(3, "a\nb\nc")] * 30
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    assert sorted((r.doc_id, sorted(r.starts)) for r in later_starts(docs).collect()) == [(2, list(range(6))), (3, [0])]
    want = [(d, "" if d in (2, 3) else t) for d, t in made]
    assert sorted(((r.doc_id, r.text) for r in remove_repeated_lines(docs).collect()), key=str) == sorted(want, key=str)
