"""The query of each operator, over whole tables, and its ANSI twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import id_files, lattice, line_dedup, merkle, mixing, prefix_trie, topk, toxicity, url_filter
from lakemart.llm.byte_bpe import decode_ids, encode_texts
from lakemart.llm.ngram_join import near_duplicates
from lakemart.llm.packing import pack
from lakemart.llm.token_counts import count_tokens
from lakemart.workspace import durable, new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 ids."""
    return pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of all documents."""
    return count_tokens(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix_sources(docs).select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "take_tokens")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every vector whose id 50 divides, among all."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", topk.sign_code(F.col("embedding")).alias("code"))
    found = topk.nearest_codes(rows, rows.where("vec_id % 50 = 0"), 10, "vec_id")
    return found.withColumnRenamed("id", "vec_id")


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to files and read back."""
    path = new_path(spark, "id-files")
    id_files.write_ids(_table(spark, sf_dir, "documents"), path)
    return id_files.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated line windows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9."""
    return lattice.link_vectors(_table(spark, sf_dir, "embeddings"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: four words, similarity 0.85."""
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=85)


def conversation_trie(conversations: DataFrame, burst_at: int = prefix_trie.BURST_AT) -> DataFrame:
    """The trie of all conversations, each of which opens with up to three turns of the one its twenty share."""
    opening = F.crc32(F.col("conv_id").cast("string")) % 4
    turns, ids = prefix_trie.graft(prefix_trie.turn_rows(conversations), F.col("conv_id") - F.pmod("conv_id", F.lit(20)), opening, 3)
    trie = prefix_trie.build_trie(durable(turns, "rebuilt-turns"), ids, burst_at)
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_words").alias("saved_tokens"))
    digests = prefix_trie.member_digests(trie.members)
    ended = trie.nodes.where("class_id is not null").join(digests, "class_id").select(*columns, F.col("digest").alias("ends_sha256"))
    passed = trie.nodes.where("class_id is null").select(*columns, F.sha2(F.lit(""), 256).alias("ends_sha256"))
    return ended.unionByName(passed)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations."""
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def prove_documents(docs: DataFrame, block_height: int = merkle.BLOCK_HEIGHT) -> DataFrame:
    """Proofs of all documents, a tree for each language, against rows of which a seventh are altered after the fact."""
    altered = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()

    def leaf(n_chars):
        return merkle.digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    own = leaf(F.col("n_chars"))
    manifest = merkle.build_manifest(
        docs, F.col("lang"), [F.col("doc_id").cast("bigint")], own,
        {"doc_id": F.col("doc_id"), "claimed": F.when(altered, leaf(F.col("n_chars") + 1)).otherwise(own)}, block_height,
    )

    def text(digest):
        return F.lower(F.hex(digest))

    return merkle.prove(manifest, "claimed", block_height).select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(text("siblings"), 256).alias("proof_sha256"), text("folded").alias("folded_root"), "verified",
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and verification of every document."""
    return prove_documents(_table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by ranks and decoded again."""
    return decode_ids(encode_texts(_table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES = {
    "op1_packing": op1_packing, "op2_url_filter": op2_url_filter, "op3_token_counts": op3_token_counts, "op4_mixing": op4_mixing,
    "op5_exact_topk": op5_exact_topk, "op6_id_files": op6_id_files, "op7_line_dedup": op7_line_dedup, "op8_toxicity": op8_toxicity,
    "op9_embedding_dedup": op9_embedding_dedup, "op10_ngram_join": op10_ngram_join,
    "op11_prefix_trie": op11_prefix_trie, "op12_merkle": op12_merkle, "op13_byte_bpe": op13_byte_bpe,
}
ORACLES = {
    "op2_url_filter": url_filter.ANSI, "op4_mixing": mixing.ANSI, "op5_exact_topk": topk.ANSI, "op7_line_dedup": line_dedup.ANSI,
    "op9_embedding_dedup": lattice.ANSI,
}
