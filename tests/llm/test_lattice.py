import numpy as np
import pytest

from lakemart.llm import lattice
from lakemart.llm.lattice import SHORTEST, _linked_blocks, e8_point, link_vectors, probe_points


def brute(made, cosine=0.9):
    ids, units = [], []
    for i, v in made:
        ids.append(i)
        v = np.array([np.nan if x is None else x for x in v], float) if v else np.zeros(1)
        good = np.isfinite(v).all() and v.any()
        units.append(v / np.linalg.norm(v) if good else None)
    n = len(made)
    link = [[a != b and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine for b in range(n)] for a in range(n)]
    root = list(range(n))
    for _ in range(n):
        new = [min([root[a]] + [root[b] for b in range(n) if link[a][b]]) for a in range(n)]
        if new == root:
            break
        root = new
    out = []
    for a in range(n):
        group = [ids[b] for b in range(n) if root[b] == root[a] and ids[b] is not None]
        first = min(group, default=None)
        out.append((ids[a], sum(link[a]), first, ids[a] == first))
    return sorted(out, key=str)


def family(seed, n=60):
    rng = np.random.default_rng(seed)
    made = []
    for width, base in ((64, 0), (24, 1000)):
        for k in range(n):
            centre = rng.standard_normal(width)
            for j in range(rng.integers(1, 6)):
                spread = rng.choice([0.0, 0.02, 0.15])
                v = centre + spread * rng.standard_normal(width)
                made.append((base + k * 10 + j, [float(np.float32(x)) for x in v * rng.choice([1, 3, 1e-3])]))
    return made


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(spark, rows, seed):
    odd = [
        (5000, None), (5001, []), (5002, [0.0] * 64), (5003, [float("nan")] + [1.0] * 63), (5004, [float("inf")] * 64), (5005, [None] + [1.0] * 63),
        (5006, [1.0] * 64), (5007, [2.0] * 64), (5007, [2.0] * 64), (None, [2.0] * 64), (5008, [1e30] * 64),
    ]
    made = family(seed) + odd
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in made], "vec_id long, embedding array<float>, kind int, unit int").repartition(5)
    assert rows(link_vectors(table)) == brute(made)


def test_links_near_the_threshold_are_found(spark):
    rng = np.random.default_rng(4)
    made, cosines = [], rng.uniform(0.9001, 0.93, 400)
    for k, c in enumerate(cosines):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        made += [(2 * k, a.tolist()), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b).tolist())]
    found = link_vectors(spark.createDataFrame(made, "vec_id long, embedding array<double>")).where("n_links > 0").count() / 2
    assert found >= 0.98 * len(cosines)


def test_decoding_gives_the_nearest_point():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1.5, (300, 8))
    point = e8_point(x)
    grid = point[:, None] + SHORTEST[None]
    assert (((x - point / 2) ** 2).sum(1)[:, None] <= ((x[:, None] - grid / 2) ** 2).sum(2) + 1e-9).all()
    assert len(np.unique(SHORTEST, axis=0)) == 240 and ((SHORTEST**2).sum(1) == 8).all()
    assert (probe_points(x, point, 4)[:, 0] == point).all()


def test_labels_of_a_block():
    rng = np.random.default_rng(3)
    close = rng.random((40, 30)) < 0.03
    a, b = _linked_blocks(close)
    assert ((a >= 0) == close.any(1)).all() and ((b >= 0) == close.any(0)).all()
    assert all(a[i] == b[j] for i, j in zip(*np.nonzero(close)))
    reach = (close.astype(int) @ close.T.astype(int)) > 0
    for _ in range(6):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    assert all((a[i] == a[j]) == reach[i, j] for i in range(40) for j in range(40) if a[i] >= 0 and a[j] >= 0)


def test_empty_table(spark):
    assert link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_every_length_is_compared(spark, monkeypatch):
    """More than a thousand lengths, and two that differ by 4,096."""
    monkeypatch.setattr(lattice, "settings", lambda n, width, *_: (0.3, 4))  # simulating pairs of each length takes minutes
    made = []
    for w in [*range(2, 1012), 1100, 5196]:
        v = np.random.default_rng(w).standard_normal(w)
        made += [(2 * w, v.tolist()), (2 * w + 1, (v * (1 + 1e-6 * np.arange(w) / w)).tolist())]
    table = spark.createDataFrame(made, "vec_id long, embedding array<double>").repartition(8)
    assert {(r.vec_id, r.n_links, r.component_id) for r in link_vectors(table).collect()} == {(i, 1, i - i % 2) for i, _ in made}
