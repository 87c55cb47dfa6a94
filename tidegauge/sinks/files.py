"""Write results: plain and bucketed folders, keyed text, Kafka, several targets at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.codec import key_value_line
from tidegauge.functions.text import as_column, field, split_fields

# Folder of each route; positions of the bucket numbers in a throughput line.
ROUTE_FOLDERS = {"al": "al", "gz": "gz", "other": "other", "json_error": "json_err"}
BUCKET_FIELDS = {"tm_num": 2, "ts_num": 3}


def append_lines(lines: DataFrame, path: str) -> None:
    """Append one text column to one folder without sub-folders."""
    lines.write.mode("append").text(path)


def bucket_fields(value: Column | str = "value") -> dict[str, Column]:
    """Bucket columns of a throughput line."""
    parts = split_fields(value, ",")
    return {name: field(parts, position) for name, position in BUCKET_FIELDS.items()}


def bucket_path(base: str, value: Column | str = "value") -> Column:
    """Folder of a throughput line, ``<base>/<tm_num>/<ts_num>/data``."""
    return F.concat_ws("/", F.lit(base), *bucket_fields(value).values(), F.lit("data"))


def write_bucketed(lines: DataFrame, path: str, *columns: str) -> None:
    """One folder per value of the columns.

    Rows are written by the tasks that hold them. An exchange by bucket would give one task
    per bucket, and the biggest bucket would hold up the job.
    """
    lines.write.mode("append").partitionBy(*columns).parquet(path)


def with_time_bucket(records: DataFrame, ms: str = "ms", pattern: str = "yyyy-MM-dd--HH") -> DataFrame:
    """Add ``bucket`` for folders by time, to be used with ``write_bucketed``."""
    return records.withColumn("bucket", F.date_format(F.timestamp_millis(as_column(ms)), pattern))


def versioned_base(base: str, version: str) -> str:
    return f"{base}/ver{version}/data"


def route_folder(route: Column | str = "route") -> Column:
    """Folder name of a route."""
    names = F.create_map(*[F.lit(x) for pair in ROUTE_FOLDERS.items() for x in pair])
    return F.element_at(names, as_column(route))


def write_keyed_text(result: DataFrame, path: str, key: str, value: str) -> None:
    """``key<TAB>value`` files, sorted by key within each file."""
    ordered = result.sortWithinPartitions(key)
    append_lines(ordered.select(key_value_line(key, value).alias("value")), path)


def kafka_columns(records: DataFrame, topic: str, value: Column | str = "value") -> DataFrame:
    """Columns of Spark's Kafka sink. An ingest time has to be part of the value."""
    columns = [as_column(value).cast("string").alias("value"), F.lit(topic).alias("topic")]
    if "partition" in records.columns:
        columns.append(F.col("partition").cast("int").alias("partition"))
    return records.select(*columns)


def write_kafka(records: DataFrame, servers: str, topic: str, value: Column | str = "value") -> None:
    """Table to a topic; needs Spark's Kafka package."""
    kafka_columns(records, topic, value).write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).save()


def stream_kafka(
    records: DataFrame, servers: str, topic: str, checkpoint: str, value: Column | str = "value"
) -> StreamingQuery:
    """Stream to a topic, at least once; needs Spark's Kafka package."""
    return (
        kafka_columns(records, topic, value)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def record_json(*columns: Column | str) -> Column:
    """Columns of a generic record as one JSON text."""
    return F.to_json(F.struct(*columns))


Writer = Callable[[DataFrame, int], None]


def fan_out(*writers: Writer) -> Writer:
    """Batch writer that hands the same micro-batch to several targets.

    The batch is computed once. Each target must take a repeated batch, see ``batch_folder``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def batch_folder(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> Writer:
    """Parquet target with one folder per micro-batch; a repeated batch replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write
