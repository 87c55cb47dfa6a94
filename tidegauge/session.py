"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings every operator relies on. Log times carry no zone, so both parsing and
# formatting are pinned to UTC; streaming state lives in RocksDB so it can outgrow the heap,
# and a batch saves its changes only.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE,
    # Of a key that a JSON object repeats, the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # The slowest source holds windows open, see ``windows.partition_watermarks``.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def build_session(app_name: str = "tidegauge", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and result tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; without that it lies in the session's
    warehouse. Where that is a folder of the driver's machine alone, only a local session may use it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        of_one_machine = base.startswith("file:") or "://" not in base
        if of_one_machine and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {base} is on one machine")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
