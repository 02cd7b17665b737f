"""Near-duplicate vectors by lattice hashing.

Each table projects unit vectors at random to eight dimensions and decodes the result to the nearest point of the E8
lattice; a vector is stored in that cell and asks in the ``probes`` nearest cells. Pairs that meet are verified by cosine,
block against block, and a block gives only links that keep its linked vectors together. Components of those links are
then compared in whole, block against block again, which counts every link inside a component, each once.

The scale of the projection follows the number of vectors, so that cells hold about as many at any size, and the number of tables
follows from the chance that two vectors at the threshold meet in one, taken from simulated pairs. Crowded cells and
components are dealt to blocks of bounded size. Equal vectors are one entry with a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.components import components
from lakemart.llm.textops import mix
from lakemart.workspace import durable, durable_observed

DIMENSIONS = 8
PROBES = 4
MISS = 0.002
BLOCK = 1024


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest point whose coordinates are integers of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def e8_point(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row, doubled to be integers."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.rint(2 * np.where(closer[:, None], whole, half)).astype(np.int64)


def _shortest() -> np.ndarray:
    """The 240 shortest lattice vectors, doubled."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (2, -2):
                for b in (2, -2):
                    out.append([a if k == i else b if k == j else 0 for k in range(8)])
    for signs in range(256):
        if bin(signs).count("1") % 2 == 0:
            out.append([-1 if signs >> k & 1 else 1 for k in range(8)])
    return np.array(out, np.int64)


SHORTEST = _shortest()


def probe_points(x: np.ndarray, point: np.ndarray, probes: int) -> np.ndarray:
    """``(rows, probes, 8)``: the cell of each row and its nearest neighbouring cells, doubled."""
    off = x - point / 2
    distance = (SHORTEST**2).sum(1)[None] / 4 - off @ SHORTEST.T
    nearest = np.argpartition(distance, probes - 1, axis=1)[:, : probes - 1]
    return np.concatenate([point[:, None], point[:, None] + SHORTEST[nearest]], 1)


def projection(table: int, width: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, table, width]).standard_normal((width, DIMENSIONS))


def cell_keys(points: np.ndarray, table: int) -> np.ndarray:
    key = np.full(points.shape[:-1], table + 1, np.uint64)
    for k in range(DIMENSIONS):
        key = mix(key + points[..., k].astype(np.uint64))
    return key.view(np.int64)


@lru_cache(maxsize=4096)
def settings(n: int, width: int, cosine: float, probes: int = PROBES, miss: float = MISS) -> tuple[float, int]:
    """``(scale, tables)`` for ``n`` vectors of ``width`` components, the same in every task."""
    scale = 0.5 * (max(n, 1000) / 50_000) ** (1 / 8)
    rng = np.random.default_rng(5)
    a = rng.standard_normal((2000, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, width))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    b = cosine * a + math.sqrt(max(0.0, 1 - cosine**2)) * b
    turn = scale * projection(0, width)
    met = np.zeros(2000, bool)
    for x, y in ((a @ turn, b @ turn), (b @ turn, a @ turn)):
        met |= (probe_points(y, e8_point(y), probes) == e8_point(x)[:, None]).all(2).any(1)
    chance = min(max(met.mean(), 0.01), 0.999)
    return scale, max(2, math.ceil(math.log(miss) / math.log(1 - chance)))


def _linked_blocks(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A label for each row and column of a table of links; linked ones share the number of their least row, others have -1."""
    rows, cols = np.flatnonzero(close.any(1)), np.flatnonzero(close.any(0))
    own, none = close[np.ix_(rows, cols)], len(close)
    left = np.arange(len(rows))
    while True:
        right = np.where(own, left[:, None], none).min(0, initial=none)
        lower = np.where(own, right[None], none).min(1, initial=none)
        if (lower >= left).all():
            break
        left = np.minimum(left, lower)
    a, b = np.full(close.shape[0], -1), np.full(close.shape[1], -1)
    a[rows], b[cols] = rows[left], rows[right]
    return a, b


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def link_vectors(vectors: DataFrame, cosine: float = 0.9, probes: int = PROBES, miss: float = MISS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Two vectors of one length link when their cosine in double precision is at least ``cosine``. ``n_links`` counts the
    other rows linked directly, ``component_id`` is the least id reachable by links. Null, empty and zero vectors and those
    with a null or non-finite component link with nothing and are kept. Repeated rows are rows of their own. Null ids
    stay null and are no component's id unless it has no other. An empty table gives none; other columns are ignored.
    Vectors of every length are compared, however many lengths there are.
    ``miss`` bounds the expected share of pairs at the threshold that never meet; no pair below it is linked.
    """
    source = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(1):
                x = x.as_py()
                v = np.array(x, np.float64) if x and None not in x else np.zeros(0)
                norm = 0.0
                if len(v) and np.isfinite(v).all():
                    v = v / np.abs(v).max() if v.any() else v
                    norm = float(np.sqrt((v * v).sum()))
                out.append((v / norm).astype("<f8").tobytes() if norm > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "unit"])

    rows, _ = durable_observed(source.mapInArrow(normalise, "vec_id bigint, unit binary"), "units", F.count("*").alias("n"))
    usual = rows.where("unit is not null").groupBy("unit").agg(F.min("vec_id").alias("first"), F.count("*").alias("size"))
    kinds, seen = durable_observed(usual.select(F.xxhash64("unit").alias("kind"), "unit", "first", "size"), "vectors", F.count("*").alias("n"))
    n = seen["n"]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, size = batch.column(0).to_numpy(), np.array([len(x.as_py()) // 8 for x in batch.column(1)])
            for w in np.unique(size).tolist():
                scale, tables = settings(n, w, cosine, probes, miss)
                pick = np.flatnonzero(size == w)
                for at in range(0, len(pick), 2048):
                    some = pick[at : at + 2048]
                    unit = np.frombuffer(b"".join(batch.column(1)[int(i)].as_py() for i in some), np.float64).reshape(-1, w)
                    for t in range(tables):
                        x = unit @ (scale * projection(t, w))
                        keys = cell_keys(probe_points(x, e8_point(x), probes), (w << 32) + t)
                        stored = np.zeros(keys.shape, bool)
                        stored[:, 0] = True
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.ravel()), pa.array(np.repeat(kind[some], probes)), pa.array(stored.ravel())], ["cell", "kind", "stored"]
                        )

    spots = durable(kinds.select("kind", "unit").mapInArrow(cells, "cell bigint, kind bigint, stored boolean"), "cells")
    # A cell matters when it stores a vector and another one asks there.
    crowd = spots.groupBy("cell").agg(F.count_if("stored").alias("stored"), F.count("*").alias("asking")).where("stored > 0 and asking > 1")
    crowd = durable(crowd.select("cell", *(F.ceil(F.col(c) / BLOCK).cast("int").alias(f"{c}_blocks") for c in ("stored", "asking"))), "crowded-cells")
    placed = spots.join(crowd, "cell")
    part = lambda n: F.pmod(F.xxhash64("kind"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stored = placed.where("stored").select("cell", part("stored_blocks").alias("i"), every("asking_blocks").alias("j"), "kind", F.lit(True).alias("left"))
    asking = placed.select("cell", every("stored_blocks").alias("i"), part("asking_blocks").alias("j"), "kind", F.lit(False).alias("left"))
    work = durable(stored.unionByName(asking), "cell-blocks").join(kinds.select("kind", "unit"), "kind")

    def meet(table: pa.Table) -> pa.Table:
        kind, left = table["kind"].to_numpy(), table["left"].to_numpy(zero_copy_only=False)
        unit = _matrix(table["unit"], len(table["unit"][0].as_py()) // 8)
        rows, cols = np.flatnonzero(left), np.flatnonzero(~left)
        a, b = _linked_blocks((unit[rows] @ unit[cols].T >= cosine) & (kind[rows][:, None] != kind[cols][None]))
        one = np.concatenate([kind[rows][a >= 0], kind[cols][b >= 0]])
        other = kind[rows][np.concatenate([a[a >= 0], b[b >= 0]])]
        keep = one != other
        return pa.table({"a": one[keep], "b": other[keep]})

    links = durable(work.groupBy("cell", "i", "j").applyInArrow(meet, "a bigint, b bigint"), "vector-links")
    labels = components(links.distinct())
    sizes = durable(labels.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "component-sizes")
    members = durable(
        labels.join(sizes, "component").join(kinds.withColumnRenamed("kind", "node"), "node").select(
            "node", "component", "blocks", "unit", "size", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("own")
        ), "members",
    )
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sides = members.select("component", F.col("own").alias("i"), every_block.alias("j"), "node", "unit", "size", F.lit(True).alias("left")).unionByName(
        members.select("component", every_block.alias("i"), F.col("own").alias("j"), "node", "unit", "size", F.lit(False).alias("left"))
    )

    def count(table: pa.Table) -> pa.Table:
        node, left = table["node"].to_numpy(), table["left"].to_numpy(zero_copy_only=False)
        unit, size = _matrix(table["unit"], len(table["unit"][0].as_py()) // 8), table["size"].to_numpy()
        rows, cols = np.flatnonzero(left), np.flatnonzero(~left)
        close = (unit[rows] @ unit[cols].T >= cosine) & (node[rows][:, None] != node[cols][None])
        return pa.table({"node": node[rows], "links": close @ size[cols].astype(np.int64)})

    counts = sides.groupBy("component", "i", "j").applyInArrow(count, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))
    least = labels.join(kinds.withColumnRenamed("kind", "node"), "node").groupBy("component").agg(F.min("first").alias("component_id"))
    labelled = labels.join(least, "component").join(counts, "node").select(F.col("node").alias("kind"), "component_id", "links")
    known = durable(kinds.select("kind", "first", "size").join(labelled, "kind", "left").select(
        "kind", F.coalesce("component_id", "first").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
    ), "vector-classes")
    linked = rows.where("unit is not null").select("vec_id", F.xxhash64("unit").alias("kind")).join(known, "kind").select("vec_id", "n_links", "component_id")
    alone = rows.where("unit is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ANSI = """
WITH usual AS (
  SELECT vec_id, [x::DOUBLE for x in embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0),
unit AS (SELECT vec_id, v, sqrt(list_sum([x * x for x in v])) AS norm FROM usual),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
reach AS (
  WITH RECURSIVE r(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN links l ON l.a = r.other)
  SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e LEFT JOIN degree d ON d.vec_id = e.vec_id JOIN reach r ON r.vec_id = e.vec_id"""
