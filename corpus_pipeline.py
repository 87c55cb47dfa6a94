"""Training-data pipeline: each stage takes what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import bpe_chunks, jaccard_groups, phrase_index, pii, quality as quality_rules
from tidegauge.llm.common import ready, stored, table
from tidegauge.llm.queries import WORD_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules reject go; a row without an id is judged by no rule and goes too."""
    ready(spark)
    kept = quality_rules.judged(docs).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    ready(spark)
    classes = jaccard_groups.near_duplicates(docs)
    later = classes.where("component_id < doc_id").select("doc_id")
    return docs.join(later, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = phrase_index.contamination(docs, table(spark, folder, "benchmark"))
    return docs.join(found.where("n_hit > 0").select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def redact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data in the texts is replaced by a sign for its kind."""
    ready(spark)
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the texts that are left."""
    ready(spark)
    coded = bpe_chunks.encode_decode(docs, WORD_BPE)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("tokens", tokens),
]

# Robust estimates and a public tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
