"""Links inside buckets without all pairs: enough verified pairs to know every cluster.

A bucket says which groups may be similar; equal pairs in many buckets and all pairs of one family are what makes similarity
jobs quadratic. Where only clusters are asked for, most of them need not be compared: two groups that other pairs already
connect are in one cluster whatever they share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.similarity import size_allows, verify
from lakemart.workspace import durable, durable_observed

BLOCK = 512


def bucket_pairs(rows: DataFrame, keys: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Every two rows of a bucket, once: ``keys`` and the other columns of both as structs ``x`` and ``y``.

    A bucket is dealt to as many blocks as ``block`` goes into its size, by a hash of ``group_id``. Pairs of blocks (i, j),
    i not after j, are the join key: a bucket of n rows is n/block tasks' worth of keys wide, each row goes to one more key
    than there are blocks, and no key holds more than about ``block`` rows of either side. Small buckets are one block.
    """
    keys = list(keys)
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(block)).alias("_blocks"), F.count("*").alias("_rows"))
    dealt = rows.join(sizes.where("_rows > 1").drop("_rows"), keys).withColumn("_own", F.pmod(F.xxhash64("group_id"), "_blocks"))
    payload = F.struct(*[c for c in rows.columns if c not in keys])
    x = dealt.select(*keys, payload.alias("x"), F.col("_own").alias("_i"), F.explode(F.sequence("_own", F.col("_blocks") - 1)).alias("_j"))
    y = dealt.select(*keys, payload.alias("y"), F.explode(F.sequence(F.lit(0).cast("bigint"), "_own")).alias("_i"), F.col("_own").alias("_j"))
    once = (F.col("_i") < F.col("_j")) | (F.col("x.group_id") < F.col("y.group_id"))
    return x.join(y, [*keys, "_i", "_j"]).where(once).select(*keys, "x", "y")


def _may_link(x: str, y: str, percent: int, placed: bool) -> Column:
    """Whether sizes (and the places of the shared shingle) let two sets reach ``percent``; one of them must be new."""
    def of(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}" if side else name)

    nx, ny = of(x, "n_shingles").cast("bigint"), of(y, "n_shingles").cast("bigint")
    allowed = size_allows(nx, ny, percent) & (of(x, "is_new") | of(y, "is_new")) & (of(x, "comp") != of(y, "comp"))
    if placed:
        left = F.least(nx - of(x, "before"), ny - of(y, "before"))
        allowed = allowed & (left * (100 + percent) >= (nx + ny) * percent)
    return allowed


def _follow(found: DataFrame, draw: int) -> DataFrame:
    """``(node, cluster)``: where each joined cluster goes, the first by the draw's order among those it was linked with, and from
    there two steps further.

    Steps go down that order, so they do not go round. Clusters that are joined but still differ are met in the next round.
    """
    a, b = (F.struct(F.xxhash64(c, F.lit(draw)).alias("at"), F.col(c).alias("comp")) for c in ("comp_a", "comp_b"))
    step = found.select(F.greatest(a, b).alias("from"), F.least(a, b).alias("to")).groupBy("from").agg(F.min("to").alias("to")).select(
        F.col("from.comp").alias("node"), F.col("to.comp").alias("cluster")
    )
    for _ in range(2):
        further = step.select(F.col("node").alias("cluster"), F.col("cluster").alias("further"))
        step = step.join(further, "cluster", "left").select("node", F.coalesce("further", "cluster").alias("cluster"))
    return step


def connect(
    rows: DataFrame, sets: DataFrame, percent: int, keys: Sequence[str], start: DataFrame | None = None, block: int = BLOCK,
) -> DataFrame:
    """Verified pairs ``(group_a, group_b, from_a, from_b)`` that connect all groups which chains of similar pairs in common
    buckets connect; ``from_*`` are the clusters both had at the start.

    ``rows(*keys, group_id, n_shingles)`` says which groups are in which bucket, with ``before`` the number of a set's
    shingles ahead of the bucket's (in one order of all shingles), if known. With ``is_new``, pairs of two old groups are taken as
    settled. ``start(node, cluster)`` are known clusters; other groups begin alone.

    1. Each bucket with more than one cluster draws one of its groups as head, all buckets by one order of clusters. Each group is
       compared with the first head among its buckets': one pair a group. What agrees joins the clusters, and a bucket whose groups
       are then in one cluster is done.
    2. As long as that settles a quarter of the rows left, it is repeated with another draw.
    3. What is left is compared in full, in blocks, but for pairs inside a cluster.

    Pairs left out are inside one cluster, so clusters are those of all similar pairs. Each round's rows are written and fewer than
    the last one's; the driver sees counts.
    """
    keys = list(keys)
    placed = "before" in rows.columns
    fields = ["group_id", "n_shingles", "is_new", *(["before"] if placed else [])]
    if "is_new" not in rows.columns:
        rows = rows.withColumn("is_new", F.lit(True))
    live = rows.select(*keys, *fields)
    if start is None:
        live = live.withColumn("origin", F.col("group_id"))
    else:
        known = start.select(F.col("node").alias("group_id"), F.col("cluster").alias("origin"))
        live = live.join(known, "group_id", "left").withColumn("origin", F.coalesce("origin", "group_id"))
    live = live.withColumn("comp", F.col("origin"))
    links, before, draw = None, None, 0
    while True:
        order = F.struct(F.xxhash64("comp", F.lit(draw)), "comp", "group_id")
        mixed = live.groupBy(*keys).agg(
            F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.max("is_new").alias("_any"),
            F.min_by(F.struct(*fields, "origin", "comp"), order).alias("head"),
        ).where("_lo < _hi and _any").select(*keys, "head")
        live, seen = durable_observed(live.join(mixed, keys), "mixed-buckets", F.count("*").alias("rows"))
        if not seen["rows"]:
            break
        last = before is not None and seen["rows"] * 4 > before * 3
        if last:
            both = bucket_pairs(live.select(*keys, *fields, "origin", "comp"), keys, block).where(_may_link("x", "y", percent, placed))
        else:
            both = live.where(_may_link("", "head", percent, placed)).select(F.struct(*fields, "origin", "comp").alias("x"), F.col("head").alias("y"))
        if not last:  # one head for each group, that of the common order
            nearest = F.min_by(F.struct("x", "y"), F.struct(F.xxhash64("y.comp", F.lit(draw)), "y.comp", "y.group_id"))
            both = both.groupBy(F.col("x.group_id").alias("_of")).agg(nearest.alias("p")).select("p.x", "p.y")
        first = F.col("x.group_id") < F.col("y.group_id")
        a, b = F.when(first, F.col("x")).otherwise(F.col("y")), F.when(first, F.col("y")).otherwise(F.col("x"))
        pairs = both.select(a.alias("a"), b.alias("b")).select(
            F.col("a.group_id").alias("group_a"), F.col("b.group_id").alias("group_b"), F.col("a.origin").alias("from_a"),
            F.col("b.origin").alias("from_b"), F.col("a.comp").alias("comp_a"), F.col("b.comp").alias("comp_b"),
        ).distinct()
        found = durable(verify(pairs, sets, percent).select(*pairs.columns), "verified-links")
        kept = found.select("group_a", "group_b", "from_a", "from_b")
        links = kept if links is None else links.unionByName(kept)
        if last:
            break
        onto = _follow(found, draw)
        live = live.drop("head").join(onto, F.col("comp") == F.col("node"), "left").withColumn(
            "comp", F.coalesce("cluster", "comp")
        ).select(*keys, *fields, "origin", "comp")
        before, draw = seen["rows"], draw + 1
    if links is None:
        one = rows.select(F.col("group_id").alias("group_a"))
        links = one.select("group_a", *[F.col("group_a").alias(c) for c in ("group_b", "from_a", "from_b")]).limit(0)
    return links
