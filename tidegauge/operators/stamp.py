"""Arrival and departure stamps, constant tags, plain copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.codec import csv_line
from tidegauge.functions.text import as_column

# Fixed value: tag of throughput lines.
THROUGHPUT_TAG = "throughput_testing"


def now_ms() -> Column:
    """Wall clock when a row is handled; two stamps of a row taken one after the other don't run backwards.

    ``current_timestamp`` would be one time for the whole (micro-)batch. Stamps that are to
    be kept have to be written or cached: a row that is computed again is stamped again.
    """
    return F.expr("cast(java_method('java.lang.System', 'currentTimeMillis') as bigint)")


def copy_lines(records: DataFrame, value: str = "value") -> DataFrame:
    """The record text alone; missing text is written as ``null``."""
    return records.select(F.coalesce(as_column(value), F.lit("null")).alias("value"))


def stamp_arrival(records: DataFrame, at: Column | None = None) -> DataFrame:
    return records.withColumn("in_time", now_ms() if at is None else at)


def stamp_departure(records: DataFrame, at: Column | None = None) -> DataFrame:
    return records.withColumn("out_time", now_ms() if at is None else at)


def stamp_both(records: DataFrame, at: Column | None = None, value: str = "value") -> DataFrame:
    """``(in_time, out_time, value, count)`` with equal stamps and a count of one."""
    stamp = now_ms() if at is None else at
    return records.select(
        stamp.alias("in_time"),
        stamp.alias("out_time"),
        as_column(value).alias("value"),
        F.lit(1).alias("count"),
    )


def tag_lines(
    records: DataFrame,
    tm_num: Column | int,
    ts_num: Column | int,
    at: Column | None = None,
    value: str = "value",
) -> DataFrame:
    """Replace the text by ``stamp,tag,tm_num,ts_num,text``."""
    tm = tm_num if isinstance(tm_num, Column) else F.lit(tm_num)
    ts = ts_num if isinstance(ts_num, Column) else F.lit(ts_num)
    line = csv_line(now_ms() if at is None else at, F.lit(THROUGHPUT_TAG), tm, ts, value)
    return records.withColumn("value", line)
