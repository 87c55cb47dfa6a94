"""Text forms of the records: CSV lines, JSON objects, bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.text import as_column, field, split_fields, to_long
from tidegauge.functions.timeconv import format_ms

# Field order of the text forms.
DELAY_FIELDS = ("in_time", "out_time", "value", "count")
COUNT_FIELDS = ("start_time", "end_time", "type", "count")


def csv_line(*columns: Column | str) -> Column:
    """Comma-joined values without quoting; a missing value is written as ``null``."""
    return F.concat_ws(
        ",", *[F.coalesce(as_column(c).cast("string"), F.lit("null")) for c in columns]
    )


def csv_bytes(*columns: Column | str) -> Column:
    return F.encode(csv_line(*columns), "UTF-8")


def key_value_line(key: Column | str, number: Column | str) -> Column:
    """``key<TAB>number``, the text form of a keyed result."""
    return F.concat_ws("\t", as_column(key), as_column(number).cast("string"))


def parse_delay(value: Column | str) -> Column:
    """Struct ``(in_time, out_time, value, count)`` of a delay line; bad numbers are NULL."""
    parts = split_fields(value, ",")
    return F.struct(
        to_long(field(parts, 0)).alias("in_time"),
        to_long(field(parts, 1)).alias("out_time"),
        field(parts, 2).alias("value"),
        to_long(field(parts, 3)).try_cast("int").alias("count"),
    )


def count_json(start: Column | str, end: Column | str, kind: Column | str, n: Column | str) -> Column:
    """JSON of one window count; every value is a string."""
    return F.to_json(
        F.struct(
            format_ms(start).alias("start_time"),
            format_ms(end).alias("end_time"),
            as_column(kind).alias("type"),
            as_column(n).cast("string").alias("count"),
        )
    )


def indicator_json(start: Column | str, end: Column | str, indicators: Column | str) -> Column:
    """JSON of one window's indicator map; every value is a string."""
    return F.to_json(
        F.struct(
            format_ms(start).alias("start_time"),
            format_ms(end).alias("end_time"),
            as_column(indicators).cast("map<string,string>").alias("indexs"),
        )
    )
