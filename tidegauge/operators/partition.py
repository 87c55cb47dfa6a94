"""Place rows on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.codec import DELAY_FIELDS, csv_line
from tidegauge.functions.hashing import field_partition, text_partition


def with_text_partition(records: DataFrame, partitions: int, value: str = "value") -> DataFrame:
    """Add ``partition`` from the characters of the record text."""
    return records.withColumn("partition", text_partition(value, partitions))


def with_delay_partition(events: DataFrame, partitions: int) -> DataFrame:
    """Add ``partition`` from the text form of a delay event."""
    return events.withColumn("partition", text_partition(csv_line(*DELAY_FIELDS), partitions))


def with_field_partition(
    records: DataFrame, name: str, partitions: int, spread: Column | str, value: str = "value"
) -> DataFrame:
    """Add ``partition`` from one JSON field, round-robin by ``spread`` without it."""
    return records.withColumn("partition", field_partition(value, name, partitions, spread))


def place_by_number(records: DataFrame, partitions: int, number: str = "partition") -> DataFrame:
    """Move every row to exactly the partition its number names."""
    return records.repartitionById(partitions, F.col(number))


def place_by_key(records: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Hash exchange: equal keys meet in one partition."""
    return records.repartition(partitions, *keys) if partitions else records.repartition(*keys)


def place_evenly(records: DataFrame, partitions: int) -> DataFrame:
    """Round-robin exchange."""
    return records.repartition(partitions)
