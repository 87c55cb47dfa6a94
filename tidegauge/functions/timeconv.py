"""Epoch and calendar conversions. Times are LONG epoch milliseconds unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.text import as_column

# Fixed value: the calendar format of log times and result times.
LOG_TIME = "yyyy-MM-dd HH:mm:ss"


def parse_ms(text: Column | str) -> Column:
    """Epoch ms of a text that starts with a log time; NULL when it does not.

    A bad time stays NULL so the row can be set aside. Falling back to the wall clock would
    move the watermark to now and make every later row late.
    """
    return F.unix_millis(F.try_to_timestamp(F.substring(as_column(text), 1, 19), F.lit(LOG_TIME)))


# Fixed value: six numbers apart as in a log time, whatever follows.
LOOSE_TIME = r"^(\d+)-(\d+)-(\d+) +(\d+):(\d+):(\d+)"


def parse_ms_lenient(text: Column | str) -> Column:
    """Epoch ms of a text that starts with a log time whose parts may have any number of digits and
    any size: month 13 is January of the next year, day 0 the last of the month before.

    NULL if a part is missing, or has more digits than a calendar can hold (4 for years and months,
    9 for the others).
    """
    text = as_column(text)
    year, month, day, hour, minute, second = (
        F.regexp_extract(text, LOOSE_TIME, i).try_cast("bigint") for i in range(1, 7)
    )
    months = year * 12 + month - 1
    first = F.make_date(div(months, F.lit(12)).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1))
    days = F.unix_date(first).cast("bigint") + day - 1
    whole = ((days * 24 + hour) * 60 + minute) * 60 + second
    sized = text.rlike(r"^\d{1,4}-\d{1,4}-\d{1,9} +\d{1,9}:\d{1,9}:\d{1,9}(\D|$)") & (months >= 12)
    return F.when(sized, whole * 1000)


def format_ms(ms: Column | str) -> Column:
    """Log time of an epoch-ms value; the milliseconds are cut off."""
    return F.date_format(F.timestamp_millis(as_column(ms)), LOG_TIME)


def event_time(ms: Column | str) -> Column:
    """Timestamp column for watermarks and windows."""
    return F.timestamp_millis(as_column(ms))


def ms_to_seconds(ms: Column | str) -> Column:
    return div(as_column(ms), F.lit(1000))


def div(left: Column, right: Column) -> Column:
    """Whole-number division that truncates toward zero."""
    return F.call_function("div", left, right)


def window_floor(ms: Column | str, size: int) -> Column:
    """Start of the epoch-aligned window of ``size`` that holds the value."""
    ms = as_column(ms)
    return ms - F.pmod(ms, F.lit(size))


def block_floor(seconds: Column | str, slot: int = 600, block: int = 10_000) -> Column:
    """Floor to ``slot`` seconds inside each ``block`` of seconds.

    Slots restart with every block, so they are not epoch-aligned and the last slot of a
    block may be shorter.
    """
    seconds = as_column(seconds)
    inside = F.pmod(seconds, F.lit(block))
    return seconds - F.pmod(inside, F.lit(slot))
