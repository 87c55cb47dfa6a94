"""Where records come from: message logs and text folders."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.sinks.folders import Folders

# Fixed value: name of a measurement file.
MEASURE_FILE = r"throughput_(\d+)_(\d+)\.csv"


def kafka_options(
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    start: str | dict[str, dict[str, int]] = "group",
    end: dict[str, dict[str, int]] | None = None,
    fail_on_loss: bool = True,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``start`` is ``earliest``, ``latest``, ``group`` or offsets per topic and partition.
    ``group`` means where this query stopped: Spark keeps that in the query's checkpoint, so
    only a first run needs a position and starts at the latest offset. With
    ``fail_on_loss=False`` a start outside the kept range is moved instead of failing.
    ``max_offsets`` bounds a micro-batch, ``min_partitions`` cuts it into tasks.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a topic pattern")
    options = {"kafka.bootstrap.servers": servers}
    options.update({"subscribe": topic} if topic else {"subscribePattern": pattern})
    if isinstance(start, dict):
        options["startingOffsets"] = json.dumps(start)
    elif start in ("earliest", "latest", "group"):
        options["startingOffsets"] = "earliest" if start == "earliest" else "latest"
    else:
        raise ValueError(f"unknown start position {start!r}")
    if end is not None:
        options["endingOffsets"] = json.dumps(end)
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    options["failOnDataLoss"] = str(fail_on_loss).lower()
    return options


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Topic as a stream ``(topic, part, off, ms, value)``; needs Spark's Kafka package."""
    return _kafka_columns(spark.readStream.format("kafka").options(**kafka_options(**options)).load())


def kafka_table(spark: SparkSession, **options) -> DataFrame:
    """An offset range of a topic as a table; needs Spark's Kafka package."""
    options.setdefault("start", "earliest")
    if options["start"] in ("latest", "group") or options.get("max_offsets"):
        raise ValueError("a table needs the earliest offset or given ones, and has no micro-batches")
    return _kafka_columns(spark.read.format("kafka").options(**kafka_options(**options)).load())


def _kafka_columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        "topic",
        F.col("partition").alias("part"),
        F.col("offset").alias("off"),
        F.unix_millis("timestamp").alias("ms"),
        F.col("value").cast("string").alias("value"),
    )


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a text file or folder as ``value``."""
    return spark.read.text(path)


def text_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, with_time: bool = False
) -> DataFrame:
    """New text files of a folder as a stream of lines ``value``, oldest file first.

    ``with_time`` adds ``ms``, when the line's file was written: the arrival time that the source knows.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(path)
    return lines.select("value", F.unix_millis("_metadata.file_modification_time").alias("ms")) if with_time else lines


def table_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, schema=None
) -> DataFrame:
    """New Parquet files as a stream. The schema is read from the files there are now."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def partition_streams(
    spark: SparkSession, path: str, column: str, partitions: list[int], schema, files_per_batch: int | None = None
) -> list[DataFrame]:
    """A log kept as one folder ``<column>=<number>`` of Parquet files per partition, as one stream each.

    The partitions are given, so that one that has no file yet is waited for.
    """
    folders, streams = Folders(spark, path), []
    for number in partitions:
        folders.make(f"{column}={number}")
        rows = table_stream(spark, f"{path}/{column}={number}", files_per_batch, schema)
        streams.append(rows.withColumn(column, F.lit(number)))
    return streams


def kafka_partition_streams(spark: SparkSession, topic: str, partitions: list[int], **options) -> list[DataFrame]:
    """The partitions of a topic as one stream each; needs Spark's Kafka package."""
    streams = []
    for number in partitions:
        settings = kafka_options(topic=topic, **options)
        del settings["subscribe"]
        streams.append(_kafka_columns(spark.readStream.format("kafka").options(**settings, assign=json.dumps({topic: [number]})).load()))
    return streams


def line_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Stream of ``value`` lines from ``kafka`` or ``text``: the same job runs on both."""
    if kind == "kafka":
        return kafka_stream(spark, **options).select("value")
    if kind == "text":
        return text_stream(spark, **options)
    raise ValueError(f"unknown source kind {kind!r}")


def measure_files(spark: SparkSession, path: str) -> DataFrame:
    """All ``throughput_<tm>_<ts>.csv`` files of a folder in one scan, with their numbers."""
    lines = spark.read.option("pathGlobFilter", "throughput_*_*.csv").text(path)
    name = F.col("_metadata.file_name")
    return lines.select(
        F.regexp_extract(name, MEASURE_FILE, 1).cast("int").alias("tm_num"),
        F.regexp_extract(name, MEASURE_FILE, 2).cast("int").alias("ts_num"),
        "value",
    )

