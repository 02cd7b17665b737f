"""A Merkle manifest of a data set: hash trees in blocks of a cache-oblivious layout, proofs and their verification.

Rows are leaves of one tree for each group, in order; the groups' roots are the leaves of the tree over all. A tree is cut
into aligned blocks of ``BLOCK_HEIGHT`` levels. A block is stored as one array in van Emde Boas order: the levels are split at
half height, the upper half comes first and the lower subtrees after it, each laid out the same way. The place of a node
follows from its level and number by arithmetic, for building and for fetching siblings alike. Block roots are the leaves
of the next tier, until one block is left. A task holds one block and its leaves, whatever share of the rows a group has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.numbering import numbered
from lakemart.workspace import durable, durable_observed

BLOCK_HEIGHT = 10

# What a level of a proof finds beside its node.
ALONE, RIGHT, LEFT = 0, 1, 2


def address(level: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where nodes ``index`` of ``level`` (0 is the root's) lie in the array of a complete tree of ``levels`` levels."""
    index = np.asarray(index, np.int64)
    at = np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if level < top:
            levels = top
            continue
        deep = level - top
        at = at + (1 << top) - 1 + (index >> deep) * ((1 << (levels - top)) - 1)
        index = index & ((1 << deep) - 1)
        level, levels = deep, levels - top
    return at


def _hash(*digests: bytes) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def _rows(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(-1, 32)


def build_block(digests: np.ndarray, height: int) -> np.ndarray:
    """The nodes above ``digests`` (one row of 32 bytes each) and these, in layout order; missing nodes are zero."""
    nodes = np.zeros(((2 << height) - 1, 32), np.uint8)
    nodes[address(height, np.arange(len(digests)), height + 1)] = digests
    row = [d.tobytes() for d in digests]
    for level in range(height - 1, -1, -1):
        row = [_hash(*row[i : i + 2]) for i in range(0, len(row), 2)]
        nodes[address(level, np.arange(len(row)), height + 1)] = _rows(b"".join(row))
    return nodes


def siblings(nodes: np.ndarray, height: int, n: int, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(digests, sides)`` beside the leaves ``index`` of a block of ``n``, a row for each leaf and a column for each level
    from below."""
    found = np.zeros((len(index), height, 32), np.uint8)
    sides = np.full((len(index), height), ALONE, np.uint8)
    for step in range(height):
        at = (index >> step) ^ 1
        there = at < -(-n >> step)
        found[there, step] = nodes[address(height - step, at[there], height + 1)]
        sides[there, step] = np.where(at[there] & 1, RIGHT, LEFT)
    return found, sides


def fold(digest: bytes, beside: bytes, sides: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    at = 0
    for side in sides:
        if side == ALONE:
            digest = _hash(digest)
            continue
        other, at = beside[at : at + 32], at + 32
        digest = _hash(digest, other) if side == RIGHT else _hash(other, digest)
    return digest


@dataclass(frozen=True)
class Manifest:
    """``leaves(_key, place, leaf, ...)``; ``tiers`` and ``top``, tables of blocks ``(_key, block, n, height, root, nodes)``
    from below for the groups' trees and for the tree over them; ``groups(_key, place, leaf)``, the groups' roots; ``root``
    (None for no rows)."""

    leaves: DataFrame
    tiers: list[DataFrame]
    groups: DataFrame
    top: list[DataFrame]
    root: bytes | None


_BLOCK_SCHEMA = "_key string, block bigint, n int, height int, root binary, nodes binary"


def _blocks(nodes: DataFrame, block_height: int) -> DataFrame:
    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        digests = _rows(b"".join(table["leaf"].to_pylist()))
        n, block = len(digests), key[1].as_py()
        # Only the first block can be alone; if it is not full, the tree ends in it.
        height = block_height if block or n == 1 << block_height else (n - 1).bit_length()
        tree = build_block(digests, height)
        return pa.table({
            "_key": pa.array([key[0].as_py()], pa.string()), "block": pa.array([block], pa.int64()), "n": pa.array([n], pa.int32()),
            "height": pa.array([height], pa.int32()), "root": pa.array([tree[0].tobytes()], pa.binary()),
            "nodes": pa.array([tree.tobytes()], pa.binary()),
        })

    dealt = nodes.select("_key", "place", "leaf", F.shiftright("place", block_height).alias("block"))
    return dealt.groupBy("_key", "block").applyInArrow(build, _BLOCK_SCHEMA)


def _tiers(nodes: DataFrame, block_height: int) -> list[DataFrame]:
    tiers = []
    while True:
        built, seen = durable_observed(_blocks(nodes, block_height), "merkle-blocks", F.max("block").alias("last"))
        tiers.append(built)
        if not seen["last"]:
            return tiers
        nodes = built.select("_key", F.col("block").alias("place"), F.col("root").alias("leaf"))


def field(value: Column) -> Column:
    """A value so that fields one after the other can be told apart: its length in bytes, a colon, the value; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """SHA-256 of the fields, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def build_manifest(
    rows: DataFrame, group: Column, order: Sequence[Column], leaf: Column, carried: dict[str, Column] | None = None,
    block_height: int = BLOCK_HEIGHT,
) -> Manifest:
    """Trees over all ``rows``: one for each value of ``group`` (null first, then by bytes), leaves ascending by ``order``.

    Nulls in ``order`` come first; rows equal in it follow their leaf, so repeated rows are as many equal leaves. ``carried``
    columns stay with the leaves. Columns of ``rows`` are only seen through the given expressions, whatever their names.
    """
    order_names = [f"_order{i}" for i in range(len(order))]
    named = rows.select(
        F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("_key"),
        *[c.alias(n) for c, n in zip(order, order_names)], leaf.alias("leaf"), *[c.alias(n) for n, c in (carried or {}).items()],
    )
    leaves = durable(numbered(named, "_key", [*order_names, "leaf"]).drop(*order_names), "merkle-leaves")
    tiers = _tiers(leaves, block_height)
    roots = tiers[-1].select(F.lit("").alias("_all"), "_key", F.col("root").alias("leaf"))
    groups = durable(numbered(roots, "_all", ["_key"]).drop("_all"), "merkle-groups")
    top = _tiers(groups.select(F.lit("").alias("_key"), "place", "leaf"), block_height)
    row = top[-1].first()
    return Manifest(leaves, tiers, groups, top, bytes(row["root"]) if row else None)


def _paths(children: DataFrame, blocks: DataFrame, upper: DataFrame, block_height: int, claim: str | None = None) -> DataFrame:
    """``children`` with ``siblings`` and ``sides`` up to the root: those in their block, then those of the block itself
    (``upper(_key, place, siblings, sides)``). With ``claim``, also ``folded``, the root that this digest leads to."""
    placed = blocks.select("_key", "block", "n", "height", "nodes").join(
        upper.select("_key", F.col("place").alias("block"), F.col("siblings").alias("_up"), F.col("sides").alias("_up_sides")),
        ["_key", "block"],
    )
    dealt = children.withColumn("block", F.shiftright("place", block_height))
    schema = T.StructType([
        *children.schema.fields, T.StructField("siblings", T.BinaryType()), T.StructField("sides", T.BinaryType()),
        *([T.StructField("folded", T.BinaryType())] if claim else []),
    ])
    names = children.columns

    def open_block(table: pa.Table, block: pa.Table) -> pa.Table:
        n, height, nodes, up, up_sides = (block[c][0].as_py() for c in ("n", "height", "nodes", "_up", "_up_sides"))
        index = table["place"].to_numpy() & ((1 << block_height) - 1)
        found, sides = siblings(_rows(nodes), height, n, index)
        beside = [f[s != ALONE].tobytes() for f, s in zip(found, sides)]
        sides = [s.tobytes() for s in sides]
        out = {c: table[c] for c in names}
        out["siblings"] = pa.array([b + up for b in beside], pa.binary())
        out["sides"] = pa.array([s + up_sides for s in sides], pa.binary())
        if claim:
            onward: dict[bytes, bytes] = {}
            folded = []
            for own, b, s in zip(table[claim].to_pylist(), beside, sides):
                reached = fold(own, b, s)
                if reached not in onward:
                    onward[reached] = fold(reached, up, up_sides)
                folded.append(onward[reached])
            out["folded"] = pa.array(folded, pa.binary())
        return pa.table(out)

    return dealt.groupBy("_key", "block").cogroup(placed.groupBy("_key", "block")).applyInArrow(open_block, schema)


def prove(manifest: Manifest, claim: str = "leaf", block_height: int = BLOCK_HEIGHT) -> DataFrame:
    """The leaves with their proofs: ``subroot`` and ``root``; ``siblings``, their digests from below, 32 bytes each; ``sides``, a
    byte for each level (0 alone, 1 sibling to the right, 2 to the left); ``folded``, the root that the leaf's column
    ``claim`` leads to beside those siblings; ``verified``, whether that is the root."""
    nothing = F.lit(b"")
    path = manifest.top[-1].select("_key", F.lit(0).cast("bigint").alias("place"), nothing.alias("siblings"), nothing.alias("sides"))
    for below, blocks in zip([*reversed(manifest.top[:-1]), None], reversed(manifest.top)):
        if below is None:
            children = manifest.groups.select(F.lit("").alias("_key"), "place", F.col("_key").alias("_group"))
        else:
            children = below.select("_key", F.col("block").alias("place"))
        path = durable(_paths(children, blocks, path, block_height), "merkle-paths")
    path = path.select(F.col("_group").alias("_key"), F.lit(0).cast("bigint").alias("place"), "siblings", "sides")
    for below, blocks in zip(reversed(manifest.tiers[:-1]), reversed(manifest.tiers[1:])):
        path = durable(_paths(below.select("_key", F.col("block").alias("place")), blocks, path, block_height), "merkle-paths")
    proven = _paths(manifest.leaves, manifest.tiers[0], path, block_height, claim)
    roots = manifest.groups.select("_key", F.col("leaf").alias("subroot"))
    root = F.lit(manifest.root).cast("binary")
    return proven.join(roots, "_key").withColumns({"root": root, "verified": F.col("folded").eqNullSafe(root)})
