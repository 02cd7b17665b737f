"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A code of 64 bits is cut into m segments of about log2(n) bits, so that a bucket holds few codes by chance. Segments are probed to
radius 0, then 1 and so on, within a radius one after the other: when segments 0 to s have been probed to radius a and
the others to a - 1, a code not yet met differs by at least (s + 1)(a + 1) + (m - s - 1)a bits, so all within ma + s
are verified. A query leaves when its k-th verified distance is covered; until then no code farther than that distance is
taken up. A code met by several segments counts at the
first, which both sides can tell from the codes alone, so nothing is deduplicated. Equal codes are one entry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.workspace import durable, durable_observed

BITS = 64
#: A radius of at most so many probes a segment is one round for all segments.
TOGETHER = 128


def sign_code(vector: Column) -> Column:
    """One bit for each of 64 components, set where it is positive; null for a vector that is null, of another length, or
    holds a component that is null or not finite."""
    usual = (F.size(vector) == BITS) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return F.when(usual, F.aggregate(bits, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseOR(x)))


def segment_widths(n: int) -> list[int]:
    """Segments of at most about log2(n) bits (8 at least), as even as 64 allows."""
    m = math.ceil(BITS / max(8.0, math.log2(max(n, 2))))
    return [BITS // m + (j < BITS % m) for j in range(m)]


def probing_order(widths: Sequence[int]) -> Iterator[tuple[int, list[int]]]:
    """``(radius, segments)`` of each round: a radius of few probes in all segments at once, others one segment at a time."""
    for radius in range(max(widths) + 1):
        wide = [j for j, width in enumerate(widths) if width >= radius]
        if math.comb(max(widths), radius) <= TOGETHER:
            yield radius, wide
        else:
            yield from ((radius, [j]) for j in wide)


def _segments(code: Column, widths: Sequence[int]) -> list[Column]:
    starts = [sum(widths[:j]) for j in range(len(widths))]
    return [
        F.call_function("shiftrightunsigned", code, F.lit(start)).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        for start, width in zip(starts, widths)
    ]


def _cut(rows: DataFrame, code: str, widths: Sequence[int], picked: Sequence[int]) -> DataFrame:
    """A row for each picked segment of each code, as ``j`` and ``value``."""
    parts = _segments(F.col(code), widths)
    held = F.explode(F.array(*(F.struct(F.lit(j).alias("j"), parts[j].alias("value")) for j in picked)))
    return rows.withColumn("__s", held).select(*rows.columns, "__s.j", "__s.value")


def _grow(probes: DataFrame, widths: Sequence[int]) -> DataFrame:
    """Each probe with one more bit turned, beyond the last one turned."""
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("j") + 1)
    grown = probes.where(F.col("last") < width - 1).withColumn("bit", F.explode(F.sequence(F.col("last") + 1, width - 1)))
    turned = F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit")))
    return grown.select("q", "qcode", "j", turned.alias("value"), F.col("bit").alias("last"), "within")


def nearest_codes(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "id", code_col: str = "code") -> DataFrame:
    """``(query_id, rank, id, distance)``: for each query its ``k`` nearest rows but itself, ties by the lower id.

    Rows and queries without code are left out, as are rows without id; fewer rows than ``k`` give fewer results. A
    query is a row of its own id. Of an id with several codes the least code counts, among rows and among queries.
    Other columns are ignored.
    """
    own = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(code_col).cast("bigint").alias("code"))
    own = own.where("id is not null and code is not null").groupBy("id").agg(F.min("code").alias("code"))
    own, seen = durable_observed(own, "codes", F.count("*").alias("n"))
    widths = segment_widths(seen["n"])
    m = len(widths)
    near = own.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("r") <= k + 1)
    near = durable(near, "code-ids")
    kinds = durable(near.groupBy("code").agg(F.min("id").alias("first"), F.count("*").alias("ids")), "code-kinds")

    asked = queries.select(F.col(id_col).cast("bigint").alias("q"), F.col(code_col).cast("bigint").alias("qcode"))
    asked = asked.where("q is not null and qcode is not null").groupBy("q").agg(F.min("qcode").alias("qcode"))
    asked = durable(asked, "queries")
    apart = F.col("qcode").bitwiseXOR(F.col("code"))
    gaps = [F.bit_count(part) for part in _segments(apart, widths)]
    order = Window.partitionBy("q").orderBy("distance", "first")
    best, left, inner, outer, at = None, None, None, [], 0
    for radius, picked in probing_order(widths):
        if radius > at:
            inner, outer, at = reduce(DataFrame.unionByName, outer), [], radius
        if inner is None:
            probes = _cut(asked, "qcode", widths, picked).withColumns({"last": F.lit(-1), "within": F.lit(BITS)})
        else:
            probes = _grow(inner.where(F.col("j").isin(picked)).drop("within").join(left, "q"), widths)
        probes = durable(probes, "probes")
        outer.append(probes)
        first_here = F.lit(True)
        for i, gap in enumerate(gaps):
            first_here = first_here & ((F.col("j") == i) | F.when(F.lit(i) < F.col("j"), gap > radius).otherwise(gap >= radius))
        met = probes.join(_cut(kinds, "code", widths, picked), ["j", "value"]).where(first_here & (F.bit_count(apart) <= F.col("within")))
        met = met.select("q", "code", "first", "ids", F.bit_count(apart).alias("distance"))
        met = met if best is None else met.unionByName(best)
        best = met.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")
        best = durable(best, "nearest")
        held = best.withColumn("upto", F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        kth = held.where(F.col("upto") >= k + 1).groupBy("q").agg(F.min("distance").alias("kth"))
        reach = asked.select("q").join(kth, "q", "left").select("q", F.coalesce("kth", F.lit(BITS)).alias("within"))
        left, count = durable_observed(reach.where(F.col("within") > m * radius + picked[-1]), "open-queries", F.count("*").alias("n"))
        if not count["n"]:
            break
    found = best.select("q", "code", "distance").join(near.select("code", "id"), "code").where("id != q")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("distance", "id"))).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias("query_id"), "rank", "id", "distance")


ANSI = """
WITH usual AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_sum([CASE WHEN (q.embedding[i] > 0) <> (c.embedding[i] > 0) THEN 1 ELSE 0 END for i in range(1, 65)]) AS distance
  FROM usual q JOIN usual c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance FROM ranked WHERE rank <= 10"""
