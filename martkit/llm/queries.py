"""Registered queries of this subpackage; every one runs over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm.chat import chat_digests, format_conversations
from martkit.llm.common import table
from martkit.llm.embeddings import link_embeddings
from martkit.llm.exact import exact_duplicates
from martkit.llm.fingerprints import add_near, edited_fingerprints
from martkit.llm.jaccard import jaccard_components
from martkit.llm.language import fit_languages, held_out, identify
from martkit.llm.lexical import build_index, search
from martkit.llm.manifest import build_manifest, prove
from martkit.llm.mixing import mix_sources
from martkit.llm.packing import pack_documents
from martkit.llm.pii import detect_pii
from martkit.llm.secrets import scan_secrets
from martkit.llm.sharding import shard_rows
from martkit.session import materialize


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, every source weighing the same, in a shuffled order."""
    return mix_sources(table(spark, sf_dir, "documents"))


def op2_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    # what was found is named by its hash, for it may be a secret
    return found.select(
        "doc_id",
        "start",
        "end",
        F.sha2(F.col("found").cast("binary"), 256).alias("found_sha256"),
        "score",
        "kept",
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    extra = [
        spark.range(1).select(
            F.lit(-7).cast("bigint").alias("conv_id"),
            F.lit(turn).cast("bigint").alias("turn"),
            F.lit(role).alias("role"),
            said.alias("text"),
        )
        for turn, role in enumerate(("user", "assistant"))
    ]
    return chat_digests(format_conversations(rows.union(extra[0]).union(extra[1])))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), percent=85, width=4)


def op6_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit_languages(docs))
    return found.withColumn("held_out", held_out(F.col("doc_id"))).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; those with an id divisible by 50 are looked up among all."""
    marks = edited_fingerprints(table(spark, sf_dir, "documents"))
    return add_near(materialize(marks, "edited-fingerprints"))


def op8_embedding_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_pii(table(spark, sf_dir, "documents"))


def op10_shard_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_bloom_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    docs = table(spark, sf_dir, "documents")
    return search(build_index(docs), docs, table(spark, sf_dir, "benchmark"), k=50)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents proven, those tampered with whose id's checksum 7 divides."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    longer = F.try_add("n_chars", F.lit(1).cast("bigint"))
    tampered = {"n_chars": F.when(checksum % 7 == 0, longer).otherwise(F.col("n_chars"))}
    manifest = build_manifest(table(spark, sf_dir, "documents"), presented=tampered)
    return prove(manifest).withColumnRenamed("key", "doc_id")


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_secret_forest": op2_secret_forest,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_chat_format": op4_chat_format,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_language_centroids": op6_language_centroids,
    "op7_simhash": op7_simhash,
    "op8_embedding_itq": op8_embedding_itq,
    "op9_pii": op9_pii,
    "op10_shard_feistel": op10_shard_feistel,
    "op11_bloom_search": op11_bloom_search,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
