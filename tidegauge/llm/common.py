"""Tables, written intermediate results and array columns shared by the operators here."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import prepare, shared_dir

# Rows of one Arrow batch: texts of a hundred kilobytes still make batches of some megabytes.
BATCH_ROWS = 500


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: later steps don't repeat the work, and
    an executor that is lost takes nothing with it."""
    spark = rows.sparkSession
    path = shared_dir(spark, name)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def give_back() -> None:
    """Hand memory that this process has freed back to the system, as far as its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that gives memory back when its task ends.

    Spark keeps a worker for later tasks. What the last one freed, often more than all that is still
    held, would stand beside the executor's heap through stages that run no Python.
    """

    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def buckets(spark: SparkSession, per_partition: int = 8) -> int:
    """How many hash buckets spread evenly over the shuffle partitions of the session."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int64)


def slot_bitmap(slots: DataFrame, size: int) -> np.ndarray:
    """Which slots (column ``slot``, 0 to size - 1) occur, as booleans: a bitmap of a fixed size,
    so it may be broadcast. What it lets through by chance is removed by the exact join after it.
    """
    words = (
        slots.groupBy((F.col("slot") - F.col("slot") % 64).alias("base"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
        .collect()
    )
    bitmap = np.zeros(size // 64, dtype=np.int64)
    for row in words:
        bitmap[row["base"] // 64] = row["bits"]
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little").astype(bool)
