"""Keyed result store: values under ``(business, key_id, timestamp)``, timestamp in seconds.

Folders are ``business/key_id/period/batch``, the batch innermost: a lookup of one key opens the
folder of its period only, however much else is stored. The value of a key is the one of its highest
``origin``, the number of the batch that wrote it.

``_log`` lists the batches. A batch has a number of its own: the caller's (``put``), or one that
``commit`` claims by creating a file that can be created once, so writers don't meet. A batch that is
repeated has its number again and replaces its own folders. ``compact`` gathers the values of finished
batches in a snapshot beside them, with their origins, and drops only what that snapshot holds. It never
touches the newest batch of a period, so that one can still be repeated.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.text import as_column
from tidegauge.functions.timeconv import div, ms_to_seconds, parse_ms
from tidegauge.sinks.folders import Folders, partition_folder

# Key of the indicator results and the time at the start of a result JSON.
INDICATOR_BUSINESS = "experimental_results"
INDICATOR_KEY = "realtime_index_count"
JSON_START = r'\{"start_time":"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})'

KEYS = ("business", "key_id", "timestamp")
PERIOD_SECONDS = 30 * 86_400
LEVELS = ("business", "key_id", "period", "batch")
STORE_SCHEMA = (
    "timestamp BIGINT, value STRING, origin BIGINT, batch BIGINT, business STRING, key_id STRING, period BIGINT"
)
LOG = "_log"


def json_start_seconds(value: Column | str, fallback: Column) -> Column:
    """Epoch seconds of ``start_time`` in a result JSON.

    Without one the fallback counts: the arrival time of the record, or null. It must not be the
    clock, or a repeated batch would write other keys.
    """
    found = ms_to_seconds(parse_ms(F.regexp_extract(as_column(value), JSON_START, 1)))
    return F.coalesce(found, fallback)


def keyed_rows(
    results: DataFrame,
    business: str = INDICATOR_BUSINESS,
    key_id: str = INDICATOR_KEY,
    value: str = "value",
    fallback: Column | None = None,
) -> DataFrame:
    """Result JSON texts as store rows; ``fallback`` gives the seconds of texts without a time."""
    fallback = F.lit(None).cast("bigint") if fallback is None else fallback
    return results.select(
        F.lit(business).alias("business"),
        F.lit(key_id).alias("key_id"),
        json_start_seconds(value, fallback).alias("timestamp"),
        as_column(value).alias("value"),
    )


def put(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write ``(business, key_id, timestamp, value)`` rows as one batch of the store.

    Rows of a period are brought together so that a batch leaves few files; adaptive execution
    splits a period that is too big for one task.
    """
    period = div(F.col("timestamp"), F.lit(PERIOD_SECONDS))
    number = F.lit(batch_id).cast("bigint")
    (
        rows.select(*KEYS, "value", number.alias("origin"), period.alias("period"), number.alias("batch"))
        .hint("rebalance", *LEVELS)
        .sortWithinPartitions(*LEVELS, "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LEVELS)
        .parquet(path)
    )
    Folders(rows.sparkSession, path).mark(f"{LOG}/{batch_id}.done")


def batch_number(spark: SparkSession, path: str, token: str) -> int:
    """The number of the batch that a writer calls ``token``; the same again for the same token.

    Data is written after the token's file only. A writer that stops between claiming a number and
    noting it leaves a number without data.
    """
    folders = Folders(spark, path)
    note = f"{LOG}/tokens/{hashlib.sha256(token.encode()).hexdigest()}"
    noted = folders.names(note)
    if noted:
        return int(noted[0])
    taken = [int(name.split(".")[0]) for name in folders.names(LOG) if name[0].isdigit()]
    number = max(taken, default=-1) + 1
    while not folders.claim(f"{LOG}/{number}.claimed"):
        number += 1
    folders.mark(f"{note}/{number}")
    return number


def commit(rows: DataFrame, path: str, token: str) -> int:
    """``put`` under a number of its own, for stores with several writers. Repeating a token replaces
    what it wrote before."""
    number = batch_number(rows.sparkSession, path, token)
    put(rows, path, number)
    return number


def periods(spark: SparkSession, path: str, business: str, key_id: str) -> list[int]:
    names = Folders(spark, path).names(f"{partition_folder('business', business)}/{partition_folder('key_id', key_id)}")
    return sorted(int(n.removeprefix("period=")) for n in names if n.removeprefix("period=").lstrip("-").isdigit())


def compact(spark: SparkSession, path: str, business: str, key_id: str, period: int) -> None:
    """Gather the values of all finished batches of a period but the newest in one snapshot.

    The snapshot of batches up to n lies in folder ``batch=-(n + 1)``. It appears by one rename,
    and batches and snapshots that it holds are dropped after that. Until then a reader finds some
    values twice, with equal origins.
    """
    folders = Folders(spark, path)
    place = "/".join(partition_folder(n, v) for n, v in zip(LEVELS, (business, key_id, period)))
    here = sorted(int(name.removeprefix("batch=")) for name in folders.names(place) if name.startswith("batch="))
    done = {int(name.removesuffix(".done")) for name in folders.names(LOG) if name.endswith(".done")}
    finished = [n for n in here if n in done]
    snapshots = [n for n in here if n < 0]
    # A batch that is still being written holds back those after it, so a snapshot says what it covers.
    pending = min((n for n in here if n >= 0 and n not in done), default=None)
    old = [n for n in finished[:-1] if pending is None or n < pending]
    if not old:
        return
    covered = max((-n - 1 for n in snapshots), default=-1)
    snapshot = -(max(old[-1], covered) + 1)
    if old[-1] > covered:
        parts = [f"{path.rstrip('/')}/{place}/batch={n}" for n in (*snapshots, *old)]
        rows = _read(spark, path, parts).groupBy("timestamp").agg(F.max_by(F.struct("value", _origin().alias("origin")), _origin()).alias("_v"))
        fresh = f"_new-{uuid.uuid4().hex}"
        rows.select("timestamp", "_v.value", "_v.origin").sortWithinPartitions("timestamp").write.parquet(f"{path.rstrip('/')}/{fresh}")
        folders.move(fresh, f"{place}/batch={snapshot}")
    for n in (*old, *(n for n in snapshots if n > snapshot)):
        folders.drop(f"{place}/batch={n}")


def store_writer(path: str, rows: Callable[[DataFrame], DataFrame] = keyed_rows, stream: str | None = None):
    """Micro-batch writer into the store. Streams that share a store need a name each."""
    if stream is None:
        return lambda batch, batch_id: put(rows(batch), path, batch_id)
    return lambda batch, batch_id: commit(rows(batch), path, f"{stream}:{batch_id}")


def put_one(
    spark: SparkSession, path: str, batch_id: int | str, business: str, key_id: str, timestamp: int, value: str
) -> None:
    """Insert one value, under a batch number or under a token that is given a number."""
    row = spark.range(1).select(
        F.lit(business).alias("business"),
        F.lit(key_id).alias("key_id"),
        F.lit(timestamp).cast("bigint").alias("timestamp"),
        F.lit(value).alias("value"),
    )
    put(row, path, batch_id) if isinstance(batch_id, int) else commit(row, path, batch_id)


# Batches from before origins were kept say their number by their folder.
def _origin() -> Column:
    return F.coalesce("origin", "batch")


def _read(spark: SparkSession, path: str, parts: list[str]) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).option("basePath", path).parquet(*parts)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All batches and snapshots; ``batch``, ``business``, ``key_id`` and ``period`` are folder columns.

    Spark lists every folder of the store for this; ``get`` doesn't.
    """
    return spark.read.schema(STORE_SCHEMA).parquet(path)


def current(stored: DataFrame) -> DataFrame:
    """Newest value per key."""
    return stored.groupBy(*KEYS).agg(F.max_by("value", _origin()).alias("value"))


def get(spark: SparkSession, path: str, business: str, key_id: str, timestamp: int) -> DataFrame:
    """Current value of one key. The folder of its period is opened by name; no other is listed."""
    period = int(timestamp / PERIOD_SECONDS)
    place = "/".join(partition_folder(n, v) for n, v in zip(LEVELS, (business, key_id, period)))
    if not Folders(spark, path).exists(place):
        return current(spark.createDataFrame([], STORE_SCHEMA))
    stored = _read(spark, path, [f"{path.rstrip('/')}/{place}"])
    return current(stored.where((F.col("period") == period) & (F.col("timestamp") == timestamp)))


def get_many(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """Current values of the keys in ``wanted``; its other columns stay.

    The keys are looked up before values are compared, so only hits are exchanged, and for a
    small set of keys Spark reads only the folders of their periods.
    """
    period = div(F.col("timestamp"), F.lit(PERIOD_SECONDS))
    keys = wanted.select(*KEYS, period.alias("period"))
    hits = stored.join(keys, [*KEYS, "period"], "left_semi")
    return wanted.join(current(hits), list(KEYS))
