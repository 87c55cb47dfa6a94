"""Word counts and the throughput and delay measurements over stamped lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.functions.text import (
    field,
    lines,
    second_key,
    split_blanks,
    split_fields,
    to_long,
    words,
)
from tidegauge.functions.timeconv import div


def word_count(texts: DataFrame, text: str = "text") -> DataFrame:
    """Rows per whitespace-separated word."""
    return (
        texts.select(F.explode(words(text)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def record_lines(records: DataFrame, value: str = "value") -> DataFrame:
    """One row per non-empty line of each record."""
    return records.select(F.explode(lines(value)).alias("value"))


def per_second_counts(stamped: DataFrame, *by: str, value: str = "value") -> DataFrame:
    """Lines per second of the second CSV field, also split ``by`` other columns.

    Lines without a usable stamp are counted under key NULL.
    """
    key = second_key(field(split_fields(value, ","), 1))
    return stamped.groupBy(*by, key.alias("key")).agg(F.count(F.lit(1)).alias("count"))


def sum_by_key(measured: DataFrame, value: str = "value") -> DataFrame:
    """Sum of ``key<blank>number`` lines per key; lines without a number are left out
    (see ``set_aside``)."""
    parts = compute_once(measured.select(value), "_f", split_blanks(value))
    pairs = parts.select(
        field(F.col("_f"), 0).alias("key"), to_long(field(F.col("_f"), 1)).alias("_n")
    )
    return pairs.where("_n IS NOT NULL").groupBy("key").agg(F.sum("_n").alias("count"))


def set_aside(measured: DataFrame, value: str = "value") -> DataFrame:
    """The lines that ``sum_by_key`` and ``mean_by_config`` leave out: those without a number."""
    return measured.where(to_long(field(split_blanks(value), 1)).isNull())


def mean_delay_per_second(stamped: DataFrame, *by: str, value: str = "value") -> DataFrame:
    """Whole-number mean of ``out - in`` per second of ``out`` over ``in,out,...`` lines, also split
    ``by`` other columns.

    Sum and count are combined separately, so the result does not depend on how the input is
    split. Lines without two stamps are left out, see ``bad_stamps``.
    """
    parts = compute_once(stamped.select(*by, value), "_f", split_fields(value, ","))
    stamps = parts.select(
        *by, to_long(field(F.col("_f"), 0)).alias("_in"), to_long(field(F.col("_f"), 1)).alias("_out")
    ).where("_in IS NOT NULL AND _out IS NOT NULL")
    key = second_key(F.col("_out").cast("string"))
    return stamps.groupBy(*by, key.alias("key")).agg(
        whole_mean(F.col("_out") - F.col("_in")).alias("delay")
    )


def bad_stamps(stamped: DataFrame, value: str = "value") -> DataFrame:
    """Lines whose first two CSV fields are not both whole numbers."""
    parts = split_fields(value, ",")
    return stamped.where(
        to_long(field(parts, 0)).isNull() | to_long(field(parts, 1)).isNull()
    )


def whole_mean(value: Column) -> Column:
    """Sum divided by count in whole numbers; NULL for no values."""
    n = F.count(value)
    return F.when(n > 0, div(F.sum(value), n))


def mean_by_config(
    measured: DataFrame, config: tuple[str, str] = ("tm_num", "ts_num"), value: str = "value"
) -> DataFrame:
    """Rows and whole-number mean of ``key<blank>number`` lines per configuration."""
    number = to_long(field(split_blanks(value), 1))
    return (
        measured.select(*config, number.alias("_n"))
        .groupBy(*config)
        .agg(F.count("_n").alias("count"), whole_mean(F.col("_n")).alias("throughput"))
    )


def tolerant_mean(measured: DataFrame, value: str = "value") -> DataFrame:
    """One row: usable lines, their mean, bad numbers (``err1``) and short lines (``err2``)."""
    text = field(split_blanks(value), 1)
    parsed = measured.select(text.alias("_t")).select("_t", to_long("_t").alias("_n"))
    return parsed.agg(
        F.count("_n").alias("count"),
        whole_mean(F.col("_n")).alias("delay"),
        F.count_if(F.col("_t").isNotNull() & F.col("_n").isNull()).alias("err1"),
        F.count_if(F.col("_t").isNull()).alias("err2"),
    )
