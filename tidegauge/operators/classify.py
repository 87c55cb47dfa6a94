"""Interaction log lines: parse, classify, turn into events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.functions.text import as_column, char_from_end, field, split_fields
from tidegauge.functions.timeconv import event_time, parse_ms

# Field order of a log line, behaviour codes, page codes, code patterns, labels.
LOG_FIELDS = (
    "time", "ip", "uid", "bhv_code", "appid", "mode", "status", "object", "opp_uid", "extend",
)
FORWARD_CODE = "14000003"
COMMENT_CODE = "14000005"
LIKE_CODE = "14000116"
LIKE_MODE = "1"
COUNTED_INSERT_TYPE = "5"
COUNTED_PAGES = ("10000408", "10000002")
INSERT_TYPE = r"insert_type:(\d*)"
SOURCE_PAGE = r"luicode:(\d*)"
# Also found inside "luicode:" and "oriuicode:"; the first hit in the text counts.
PAGE = r"uicode:(\d*)"
FORWARD, COMMENT, LIKE, OTHER = "fwd", "cmt", "lk", "other"
GROUP_POSITION = 5
BAD_RECORD = "bad_record"


def log_fields(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add the ten fields of a log line; all are NULL when the line has fewer."""
    split = compute_once(lines, "_f", split_fields(value, "\t"))
    whole = F.size("_f") >= len(LOG_FIELDS)
    return split.select(
        *lines.columns,
        *[
            F.when(whole, field(F.col("_f"), i)).alias(name)
            for i, name in enumerate(LOG_FIELDS)
        ],
    )


def user_group(uid: Column | str, digit: int, fixed: bool = False) -> Column:
    """Group label ``_<digit>_<c>`` from one character of the user id.

    The established labels read the fifth character from the end whatever ``digit`` is, for
    ids longer than ``digit``; other ids belong to group ``null``. ``fixed=True`` reads the
    character at ``digit`` instead.
    """
    uid = as_column(uid)
    position = digit if fixed else GROUP_POSITION
    char = F.when(F.length(uid) > digit, char_from_end(uid, position))
    return F.concat(F.lit(f"_{digit}_"), F.coalesce(char, F.lit("null")))


def interaction_type(digit: int, fixed: bool = False) -> Column:
    """Type label from the columns of ``log_fields``."""
    extend = F.col("extend")
    group = user_group("uid", digit, fixed)
    counted = F.regexp_extract(extend, INSERT_TYPE, 1) == COUNTED_INSERT_TYPE
    from_page = F.regexp_extract(extend, SOURCE_PAGE, 1).isin(*COUNTED_PAGES)
    on_page = F.regexp_extract(extend, PAGE, 1).isin(*COUNTED_PAGES)
    code = F.col("bhv_code")
    return (
        F.when(extend.isNull(), BAD_RECORD)
        .when(counted & (code == FORWARD_CODE) & from_page, F.concat(F.lit(FORWARD), group))
        .when(counted & (code == COMMENT_CODE) & from_page, F.concat(F.lit(COMMENT), group))
        .when(
            counted & (code == LIKE_CODE) & (F.col("mode") == LIKE_MODE) & on_page,
            F.concat(F.lit(LIKE), group),
        )
        .otherwise(OTHER)
    )


def classify(lines: DataFrame, digit: int, value: str = "value", fixed: bool = False) -> DataFrame:
    """Add ``ms`` (event time) and ``type``.

    Short lines and lines without a time get type ``bad_record`` and no ``ms``.
    """
    parsed = compute_once(log_fields(lines, value), "ms", parse_ms("time"))
    kind = F.when(F.col("ms").isNull(), BAD_RECORD).otherwise(interaction_type(digit, fixed))
    return parsed.withColumn("type", kind).select(*lines.columns, "ms", "type")


def interaction_events(lines: DataFrame, digit: int, value: str = "value") -> DataFrame:
    """Usable lines as ``(ts, ms, type)`` events, ready for watermarks and windows."""
    usable = classify(lines.select(value), digit, value).where("ms IS NOT NULL")
    return usable.select(event_time("ms").alias("ts"), "ms", "type")


def bad_records(lines: DataFrame, digit: int, value: str = "value") -> DataFrame:
    """Lines the event stream leaves out, unchanged."""
    return classify(lines, digit, value).where("ms IS NULL").select(*lines.columns)
