"""LSH candidates: buckets, their skew, candidate pairs, verification, recall and cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import minhash as M
from lakemart.operators.linking import BLOCK, bucket_pairs
from lakemart.operators.quantiles import exact_percentiles
from lakemart.operators.similarity import size_allows, verify

BUCKET_CAP = 50
ERROR_BANDS = ((0.0, 0.2), (0.2, 0.5), (0.5, 0.8), (0.8, 1.0))


def band_rows(groups: DataFrame) -> DataFrame:
    """``(band_id, bucket_hash, group_id, n_docs)``: sixteen rows per content group."""
    return groups.select(
        "group_id", "n_docs", F.posexplode("bands").alias("band_id", "bucket_hash")
    )


def bucket_sizes(bands: DataFrame) -> DataFrame:
    """Groups and notices per bucket."""
    return bands.groupBy("band_id", "bucket_hash").agg(
        F.count("*").alias("groups"), F.sum("n_docs").alias("docs")
    )


def notice_bands(bands: DataFrame, members: DataFrame) -> DataFrame:
    """Band rows of single notices, ``(band_id, bucket_hash, doc_id)``."""
    return bands.join(members, "group_id").select("band_id", "bucket_hash", "doc_id")


def candidate_pairs(bands: DataFrame, members: DataFrame, cap: int) -> DataFrame:
    """Distinct notice pairs that share a bucket of at most ``cap`` notices, ``kind = 'pair'``.

    A larger bucket is not expanded into pairs and not dropped either: it is listed once, as its smallest
    notice with each of the others, ``kind = 'bucket'``. ``verified_pairs`` compares all buckets, in blocks.
    """
    sizes = bucket_sizes(bands)
    small = sizes.where(F.col("docs").between(2, cap)).select("band_id", "bucket_hash")
    rows = notice_bands(bands.join(small, ["band_id", "bucket_hash"], "left_semi"), members)
    a, b = rows.withColumnRenamed("doc_id", "doc_a"), rows.withColumnRenamed("doc_id", "doc_b")
    pairs = (
        a.join(b, ["band_id", "bucket_hash"]).where(F.col("doc_a") < F.col("doc_b"))
        .select("doc_a", "doc_b").distinct()
    )
    heads = (
        bands.groupBy("band_id", "bucket_hash")
        .agg(F.sum("n_docs").alias("docs"), F.min("group_id").alias("doc_a"))
        .where(F.col("docs") > cap).drop("docs")
    )
    large = (
        notice_bands(bands.join(heads, ["band_id", "bucket_hash"], "left_semi"), members)
        .join(heads, ["band_id", "bucket_hash"]).where(F.col("doc_a") < F.col("doc_id"))
        .select("doc_a", F.col("doc_id").alias("doc_b")).distinct()
    )
    return pairs.withColumn("kind", F.lit("pair")).unionByName(large.withColumn("kind", F.lit("bucket")))


def colliding_pairs(rows: DataFrame, percent: int, block: int) -> DataFrame:
    """``(x, y)``: every two groups that share a bucket and whose sizes allow ``percent``, once, in the first band they share.

    ``rows(group_id, n_shingles, bands, ...)``; ``x`` and ``y`` hold their columns.
    """
    banded = rows.select("*", F.posexplode("bands").alias("band_id", "bucket_hash"))
    both = bucket_pairs(banded, ["band_id", "bucket_hash"], block)
    agree = F.zip_with("x.bands", "y.bands", lambda p, q: p == q)
    first = F.array_position(agree, F.lit(True)) == F.col("band_id") + 1
    return both.where(size_allows(F.col("x.n_shingles"), F.col("y.n_shingles"), percent) & first).select("x", "y")


def verified_pairs(groups: DataFrame, sets: DataFrame, percent: int, cap: int = BLOCK) -> DataFrame:
    """Pairs of content groups that share a bucket and whose exact Jaccard reaches ``percent``.

    ``groups(group_id, n_docs, n_shingles, bands)`` is light; ``sets(group_id, n_shingles, shingles)`` is only joined to
    the candidates. Buckets are compared in blocks of about ``cap`` groups, large and small ones alike; a pair counts in the first
    band it shares, so candidates are not shuffled to be made distinct. Where clusters are all that is wanted,
    ``linking.connect`` compares far fewer pairs.
    """
    both = colliding_pairs(groups.select("group_id", "n_shingles", "bands"), percent, cap)
    pairs = both.select(
        F.least("x.group_id", "y.group_id").alias("group_a"), F.greatest("x.group_id", "y.group_id").alias("group_b")
    )
    return verify(pairs, sets, percent)


def candidate_load(bands: DataFrame, cap: int | None = None) -> DataFrame:
    """Comparisons per notice, ``(group_id, n_docs, load)``: bucket size less one, over all its buckets.

    With a cap, larger buckets count nothing; a notice that is only in such buckets has load 0.
    """
    sizes = bucket_sizes(bands)
    if cap is not None:
        sizes = sizes.where(F.col("docs") <= cap)
    sized = bands.join(sizes.select("band_id", "bucket_hash", "docs"), ["band_id", "bucket_hash"], "left")
    return sized.groupBy("group_id", "n_docs").agg(F.coalesce(F.sum(F.col("docs") - 1), F.lit(0)).alias("load"))


def load_summary(load: DataFrame, stage: str) -> DataFrame:
    """Mean, median, 95th and 99th percentile, maximum and total of the load over notices."""
    staged = load.select(F.lit(stage).alias("stage"), "load", "n_docs")
    found = exact_percentiles(
        staged, ["stage"], "load", {"median": 0.5, "p95": 0.95, "p99": 0.99}, weight=F.col("n_docs")
    )
    return found.select(
        "stage", F.col("count").alias("notices"), (F.col("sum") / F.col("count")).alias("mean"), "median", "p95", "p99",
        F.col("maximum").alias("max"), F.floor(F.col("sum") / 2).cast("bigint").alias("total_comparisons"),
    )


def largest_buckets(bands: DataFrame, n: int = 15) -> DataFrame:
    """The n largest buckets by notices."""
    return (
        bucket_sizes(bands).select("band_id", "bucket_hash", "docs")
        .orderBy(F.col("docs").desc(), "band_id", "bucket_hash").limit(n)
    )


def bucket_mix(bands: DataFrame, members: DataFrame, notices: DataFrame, key: str) -> DataFrame:
    """Which portals fill the largest bucket: count and percent."""
    largest = largest_buckets(bands, 1)
    inside = bands.join(largest, ["band_id", "bucket_hash"]).select("group_id", F.col("docs").alias("bucket_docs"))
    docs = members.join(inside, "group_id").join(notices.select("doc_id", key), "doc_id")
    return docs.groupBy(key).agg(F.count("*").alias("docs"), F.max("bucket_docs").alias("bucket_docs")).select(
        key, "docs", F.round(F.col("docs") / F.col("bucket_docs") * 100, 1).alias("pct")
    )


def recall(truth: DataFrame, groups: DataFrame, cap: int | None = None) -> DataFrame:
    """Share of true notice pairs that the buckets retrieve.

    ``truth(group_a, group_b, doc_pairs)`` in compact form. A pair is a hit when both groups are in one
    bucket that the cap lets through, read off their bucket lists without building candidate pairs.
    """
    bands = band_rows(groups)
    kept = bucket_sizes(bands)
    if cap is not None:
        kept = kept.where(F.col("docs") <= cap)
    usable = bands.join(kept.select("band_id", "bucket_hash"), ["band_id", "bucket_hash"], "left_semi")
    keys = usable.groupBy("group_id").agg(F.collect_set(F.struct("band_id", "bucket_hash")).alias("keys"))
    a = keys.select(F.col("group_id").alias("group_a"), F.col("keys").alias("keys_a"))
    b = keys.select(F.col("group_id").alias("group_b"), F.col("keys").alias("keys_b"))
    joined = truth.join(a, "group_a", "left").join(b, "group_b", "left")
    hit = F.coalesce(F.arrays_overlap("keys_a", "keys_b"), F.lit(False))
    return joined.agg(
        F.coalesce(F.sum("doc_pairs"), F.lit(0)).alias("truth"),
        F.coalesce(F.sum(F.when(hit, F.col("doc_pairs"))), F.lit(0)).alias("hits"),
    ).withColumn("recall", F.col("hits") / F.nullif("truth", F.lit(0)))


def error_summary(scored: DataFrame) -> DataFrame:
    """Bias, mean absolute, root mean square, standard and largest error of the estimate."""
    error = F.col("estimate") - F.col("jaccard")
    return scored.agg(
        F.count("*").alias("pairs"), F.avg(error).alias("bias"), F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.stddev_pop(error).alias("std"), F.max(F.abs(error)).alias("max_abs"),
    )


def similarity_band(similarity: Column, edges: tuple[tuple[float, float], ...] = ERROR_BANDS) -> Column:
    """Lower edge of the band a similarity is in; bands are half-open, the last one includes its end."""
    band = F.lit(None).cast("double")
    for low, high in edges:
        inside = (similarity >= low) & ((similarity <= high) if high == edges[-1][1] else (similarity < high))
        band = F.when(inside, F.lit(low)).otherwise(band)
    return band


def error_by_band(scored: DataFrame, signature_size: int = M.SIGNATURE_SIZE) -> DataFrame:
    """Measured and theoretical error of the estimate per similarity band."""
    error = F.col("estimate") - F.col("jaccard")
    per_band = scored.groupBy(similarity_band(F.col("jaccard")).alias("band")).agg(
        F.count("*").alias("pairs"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg("jaccard").alias("mean_jaccard")
    )
    theory = F.sqrt(F.col("mean_jaccard") * (1 - F.col("mean_jaccard")) / signature_size)
    return per_band.select("band", "pairs", "rmse", theory.alias("theory"))


def cost_sweep(
    scored: DataFrame, thresholds_percent: tuple[int, ...], score: str = "estimate", cost_fp: int = 100, cost_fn: int = 1
) -> DataFrame:
    """False merges and misses at each threshold and their weighted cost.

    One pass over the pairs: each is counted under every threshold, a fixed short list.
    """
    taken = F.explode(F.array(*[
        F.struct(F.lit(t).alias("threshold_pct"), (F.col(score) >= t / 100.0).alias("merged")) for t in thresholds_percent
    ]))
    counted = scored.select("label", taken.alias("at")).groupBy("at.threshold_pct").agg(
        F.count_if(F.col("at.merged") & (F.col("label") == "different")).alias("false_merges"),
        F.count_if(~F.col("at.merged") & (F.col("label") == "same")).alias("misses"),
    )
    cost = F.col("false_merges") * cost_fp + F.col("misses") * cost_fn
    return counted.withColumn("cost", cost)


def operating_point(sweep: DataFrame) -> DataFrame:
    """The cheapest threshold; the highest of equally cheap ones."""
    return sweep.orderBy("cost", F.col("threshold_pct").desc()).limit(1)


def survival_calibration(scored: DataFrame, configs: tuple[tuple[int, int], ...] = M.BAND_CONFIGS) -> DataFrame:
    """Predicted and observed share of candidates by similarity band, for each bands x rows split."""
    per_config = F.explode(F.array(*[
        F.struct(
            F.lit(b).alias("bands"), F.lit(r).alias("rows"),
            M.survival_probability(F.col("jaccard"), b, r).alias("predicted"),
            M.shares_band(F.col("signature_a"), F.col("signature_b"), b, r).cast("int").alias("observed"),
        ) for b, r in configs
    ]))
    rows = scored.select(similarity_band(F.col("jaccard")).alias("band"), per_config.alias("c"))
    return rows.groupBy("c.bands", "c.rows", "band").agg(
        F.count("*").alias("pairs"), F.avg("c.predicted").alias("predicted"), F.avg("c.observed").alias("observed")
    )
