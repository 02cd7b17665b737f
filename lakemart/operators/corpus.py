"""Notices reduced to what the similarity jobs need, each distinct content once.

Notices with the same shingle set are one *content group*. Everything that compares notices works on groups
and carries the number of notices in each: a text that makes up a third of the corpus is one row, and its
quadratically many identical pairs are a number, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import minhash as M
from lakemart.functions import text as X
from lakemart.workspace import durable, durable_by


@dataclass(frozen=True)
class Corpus:
    """``sketches(doc_id, content_key, n_shingles, shingles, parity, bands)`` per notice, in buckets of ``doc_id``,
    ``groups(group_id, n_docs, n_shingles, bands)`` per content, ``members(doc_id, group_id)``.

    A group's id is its smallest notice id, so a group's shingles are that notice's: the sets, which are
    larger than the texts, are written once and never copied per group.
    """

    sketches: DataFrame
    groups: DataFrame
    members: DataFrame

    @property
    def sets(self) -> DataFrame:
        """Shingle sets by notice id, for looking up pairs of groups."""
        return self.sketches.select(F.col("doc_id").alias("group_id"), "n_shingles", "parity", "shingles")

    @property
    def group_sets(self) -> DataFrame:
        """Each distinct content's set once."""
        return self.sets.join(self.groups.select("group_id"), "group_id", "left_semi")


def sketch(
    notices: DataFrame, *, k: int = 3, rules: Sequence[X.CleanRule] = X.RAW_RULES, title: Column | None = None,
    id_col: str = "doc_id", body_col: str = "text",
) -> DataFrame:
    """Shingle set, content key, parities, signature and bucket hashes per notice, from whole texts."""
    words = notices.select(
        F.col(id_col).alias("doc_id"), X.tokens(X.cleaned(title, F.col(body_col), rules)).alias("words")
    )
    hashed = words.select("doc_id", M.sketched(F.col("words"), k).alias("s")).select("doc_id", "s.*")
    return hashed.select("doc_id", "content_key", F.size("shingles").alias("n_shingles"), "shingles", "parity", "signature", "bands")


def membership(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Content keys as ``keys(content_key, group_id, n_docs)`` and notices as ``members(doc_id, group_id)``."""
    keys = sketches.groupBy("content_key").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("n_docs"))
    members = sketches.select("doc_id", "content_key").join(
        keys.select("content_key", "group_id"), "content_key"
    ).select("doc_id", "group_id")
    return keys, members


def build_corpus(notices: DataFrame, **options) -> Corpus:
    """Sketch all notices once and group them by content; both tables are written, later steps read them.

    Group rows are picked by notice id, which is unique, so a hot content key never moves its copies. Sketches are moved once, into
    buckets of notice ids; picking rows and looking up the sets of pairs reads them where they are.
    """
    sketches = durable_by(sketch(notices, **options).drop("signature"), "sketches", "doc_id")
    keys, members = membership(sketches)
    signed = sketches.select(F.col("doc_id").alias("group_id"), "n_shingles", "bands")
    groups = signed.join(keys.select("group_id", "n_docs"), "group_id").select(
        "group_id", "n_docs", "n_shingles", "bands"
    )
    return Corpus(sketches, durable(groups, "groups"), members)


def copy_pairs(groups: DataFrame) -> DataFrame:
    """Identical notices as one row per group: the group with itself, standing for all its pairs."""
    n = F.col("n_docs")
    return groups.where((n > 1) & (F.col("n_shingles") > 0)).select(
        F.col("group_id").alias("group_a"), F.col("group_id").alias("group_b"), F.lit(1.0).alias("jaccard"),
        F.floor(n * (n - 1) / 2).cast("bigint").alias("doc_pairs"),
    )
