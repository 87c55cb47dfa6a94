"""Registered queries of this package: whole tables in, the digest columns of each operator out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import bpe_chunks, jaccard_groups, license_scan, phrase_index, phrase_mining, pii, prefix_trie, pseudo_lm, quality, repair_files, secret_scan, sharding, tool_links
from tidegauge.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def op1_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii.summary(pii.find(table(spark, folder, "documents")))


def op2_tool_call_links(spark: SparkSession, folder: str) -> DataFrame:
    messages = tool_links.derived_messages(table(spark, folder, "conversations"))
    return tool_links.linked(messages, tool_links.TOOLS)


def op3_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.sharded(table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op4_repair_token_files(spark: SparkSession, folder: str) -> DataFrame:
    read = repair_files.token_files(table(spark, folder, "documents"), BYTE_BPE, END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_jaccard_groups(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups.near_duplicates(table(spark, folder, "documents"))


def op7_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_lm.pseudo_likelihood(table(spark, folder, "documents"))


def op8_secret_entropy(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.summary(secret_scan.find(table(spark, folder, "documents")))


def contaminated(found: DataFrame) -> DataFrame:
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "matches",
    )


def op9_phrase_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(phrase_index.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


def op10_bpe_chunk_reuse(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe_chunks.encode_decode(table(spark, folder, "documents"), WORD_BPE)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


def op11_setm_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, folder, "documents"))


def op12_license_diagonals(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, folder, "documents")))


def op13_zfast_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii_spans, op2_tool_call_links, op3_vector_packing, op4_repair_token_files, op5_robust_outliers, op6_jaccard_groups, op7_pseudo_likelihood,
        op8_secret_entropy, op9_phrase_decontamination, op10_bpe_chunk_reuse,
        op11_setm_collocations, op12_license_diagonals, op13_zfast_trie,
    )
}
