"""The corpus pipeline: stages over documents, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import line_dedup, mixing, ngram_join, packing, toxicity
from lakemart.workspace import durable

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model learns from the labelled documents of ``sf_dir``."""
    source, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return toxicity.score(docs, toxicity.fit(source, labels)).where("toxicity < 0.5").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three lines; one of which nothing is left goes."""
    had_words = mixing.word_count(F.col("text")) > 0
    cleaned = line_dedup.remove_repeated_lines(docs.withColumn("__had", had_words), kept_col="__lines", removed_col="__gone")
    whole = cleaned.where((F.col("__gone") == 0) | (mixing.word_count(F.col("text")) > 0) | ~F.col("__had"))
    return whole.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one document of each group of near duplicates (five words, similarity 0.8): the one of the least id.

    Rows without id come after all ids, so one stays only where its whole group has none; a repeated row stays once.
    """
    return ngram_join.one_row_of_each_group(docs.select(*COLUMNS)).select(*COLUMNS)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen by hierarchical token budgets, once for each epoch that reads them, whole."""
    return mixing.mix_sources(docs.select(*COLUMNS)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences of 2048 ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("n-gram Jaccard join", one_of_each_group),
    ("mixing", mix_to_weights), ("packing", pack_sequences),
]
#: Neither the classifier nor the tokenizer is SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
