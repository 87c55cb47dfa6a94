"""Shards by vector bin packing: bytes, tokens and rows balanced jointly.

Rows of equal text form a group. Groups are packed largest first into the shard where the dot
product of the group's vector with the shard's remaining capacity is highest, among the shards
that have room for its bytes if there are any. What is packed are at most BUNDLES bundles of groups, told by the
groups' hash, and pieces of the few groups that are large by themselves, so the packing handles a
fixed number of items whatever the table's size, while all sums are formed by Spark.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.llm.common import stored

SHARDS = 8
BUNDLES = 8192
# A group beyond this part of a shard's capacity, in any dimension, is split into pieces of it.
LARGE = 1 / 4
SLOT_BUCKETS = 1024
DIMENSIONS = ["size", "tokens", "one"]
# Bytes count most in the dot product: their balance is the law that the shards keep.
WEIGHTS = np.array([10.0, 1.0, 1.0])


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, tokens, one, text_crc32, key_a, key_b)``: sizes and the group of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = compute_once(docs.select(F.col("doc_id").cast("bigint"), text.alias("text")), "tokens", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"))
    return rows.select(
        "doc_id", (F.octet_length("text") + 1).cast("bigint").alias("size"), "tokens", F.lit(1).cast("bigint").alias("one"),
        F.crc32("text").alias("text_crc32"), F.xxhash64("text").alias("key_a"), F.xxhash64(F.lit("second"), F.col("text")).alias("key_b"),
    )


def pack(loads: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item; ``loads`` has a row for each item and a column for each dimension."""
    totals = loads.sum(axis=0)
    share = loads / np.where(totals > 0, totals / shards, 1.0)
    free = np.ones((shards, loads.shape[1]))
    weighted = share * WEIGHTS
    placed = np.zeros(len(loads), dtype=np.int64)
    for i in np.argsort(-weighted.max(axis=1), kind="stable"):
        fits = free[:, 0] >= share[i, 0] - 1e-12
        value = free @ weighted[i]
        placed[i] = int(np.argmax(np.where(fits, value, -np.inf) if fits.any() else value))
        free[placed[i]] -= share[i]
    return placed


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, tokens, text_crc32, shard, slot)`` of every row; slots of a shard run from 0.

    Null texts count as empty: size 1, no tokens. Rows that repeat are rows each. An empty table
    gives no rows. Equal texts share a shard unless their group is larger than LARGE of a shard.
    """
    spark = docs.sparkSession
    rows = stored(measured(docs), "measured")
    key = ["key_a", "key_b"]
    sums = [F.sum(d).alias(d) for d in DIMENSIONS]
    total = rows.agg(*sums).first()
    most = {d: max(1.0, LARGE * (total[d] or 0) / shards) for d in DIMENSIONS}
    groups = rows.groupBy(*key).agg(*sums)
    pieces = F.ceil(F.greatest(*(F.col(d) / F.lit(float(most[d])) for d in DIMENSIONS))).cast("bigint")
    # At most three times shards / LARGE groups are that large, a dimension each.
    large = F.broadcast(groups.where(" OR ".join(f"{d} > {most[d]!r}" for d in DIMENSIONS) + " AND one > 1").select(*key, pieces.alias("pieces")))
    piece = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.col("pieces"))
    bundle = F.when(F.col("pieces").isNotNull(), F.concat_ws("-", F.lit("g"), "key_a", "key_b", piece)).otherwise(F.concat(F.lit("b"), F.pmod("key_a", F.lit(BUNDLES))))
    rows = rows.join(large, key, "left").withColumn("bundle", bundle).drop("pieces", *key)
    items = sorted(rows.groupBy("bundle").agg(*sums).collect(), key=lambda r: r["bundle"])
    placed = pack(np.array([[r[d] for d in DIMENSIONS] for r in items], dtype=float).reshape(-1, len(DIMENSIONS)), shards)
    plan = spark.createDataFrame([(r["bundle"], int(s)) for r, s in zip(items, placed)], "bundle STRING, shard INT")
    rows = stored(rows.join(F.broadcast(plan), "bundle").drop("bundle", "one"), "placed")

    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(SLOT_BUCKETS)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = rows.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    # One begin for each shard and bucket: a fixed number.
    numbered = rows.withColumn("within", within - 1).join(F.broadcast(begins), ["shard", "bucket"])
    return numbered.select("doc_id", "size", "tokens", "text_crc32", "shard", (F.col("begin") + F.col("within")).cast("bigint").alias("slot"))
