"""Event-time windows: watermark, counts per window, indicator maps, late-row audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.functions.text import as_column, field, split_fields, to_long
from tidegauge.functions.timeconv import event_time, window_floor
from tidegauge.operators.classify import OTHER
from tidegauge.operators.running import running_by_key

# How far out of order rows may arrive; how long after a window its map is due.
MAX_OUT_OF_ORDER_MS = 3_500
INDICATOR_DELAY_MS = 600_000


def with_watermark(events: DataFrame, delay_ms: int = MAX_OUT_OF_ORDER_MS) -> DataFrame:
    """Bound the lateness of ``ts``; Spark ignores it on a table."""
    return events.withWatermark("ts", f"{delay_ms} milliseconds")


def partition_watermarks(streams: list[DataFrame], delay_ms: int = MAX_OUT_OF_ORDER_MS) -> DataFrame:
    """One stream of all log partitions, given as a stream each, whose watermark is that of the slowest.

    Every partition has its own watermark, ``delay_ms`` behind its newest ``ts``; the bound for windows
    and late rows is their minimum, which never falls. A partition that has brought no row since the
    query was started holds every window open: only the minimum outlives a restart. It needs ``spark.sql.streaming.multipleWatermarkPolicy``
    at ``min``, which ``session.prepare`` sets.
    """
    marked = [with_watermark(stream, delay_ms) for stream in streams]
    result = marked[0]
    for other in marked[1:]:
        result = result.unionByName(other)
    return result


def with_ingestion_time(records: DataFrame) -> DataFrame:
    """Event time = time of arrival: ``ms`` and ``ts`` of the running (micro-)batch.

    Such times never run backwards, so a watermark on them needs no delay.
    """
    return records.withColumn("ts", F.current_timestamp()).withColumn("ms", F.unix_millis("ts"))


def tumbling(size_ms: int, time: Column | str = "ts") -> Column:
    return F.window(time, f"{size_ms} milliseconds")


def window_counts(events: DataFrame, size_ms: int) -> DataFrame:
    """Rows per type and window: ``(window, start_time, end_time, type, count)``.

    The count is summed before the exchange, so a dominating type costs one row per task and
    window. ``window`` stays so that a stream can chain another aggregation on it.
    """
    counted = events.groupBy(tumbling(size_ms).alias("window"), "type").agg(
        F.count(F.lit(1)).alias("count")
    )
    return counted.select(
        "window",
        F.unix_millis("window.start").alias("start_time"),
        (F.unix_millis("window.end") - 1).alias("end_time"),
        "type",
        "count",
    )


def window_indicators(counts: DataFrame, size_ms: int, closing_type: str = OTHER) -> DataFrame:
    """One map ``type -> count`` per window that contains the closing type.

    Input is the result of ``window_counts``, so a group holds one row per distinct type.
    """
    entries = F.array_sort(F.collect_list(F.struct("type", "count")))
    grouped = counts.groupBy(tumbling(size_ms, F.window_time("window")).alias("window")).agg(
        F.map_from_entries(entries).alias("indexs"),
        F.max(F.col("type") == closing_type).alias("_closed"),
    )
    return grouped.where("_closed").select(
        F.unix_millis("window.start").alias("start_time"),
        (F.unix_millis("window.end") - 1).alias("end_time"),
        "indexs",
    )


def due_indicators(
    counts: DataFrame, size_ms: int, delay_ms: int = INDICATOR_DELAY_MS, closing_type: str = OTHER
) -> DataFrame:
    """``window_indicators`` that come ``delay_ms`` of event time after their window has closed.

    The maps are built over windows that are longer by the delay and start with every plain window, so
    the watermark closes them that much later. Of the longer windows that hold a count, only
    the one with the count's own start is kept.
    """
    timed = counts.select(
        "start_time", "type", "count",
        F.window(F.window_time("window"), f"{size_ms + delay_ms} milliseconds", f"{size_ms} milliseconds").alias("due"),
    ).where(F.unix_millis("due.start") == F.col("start_time"))
    entries = F.array_sort(F.collect_list(F.struct("type", "count")))
    grouped = timed.groupBy("due").agg(
        F.map_from_entries(entries).alias("indexs"), F.max(F.col("type") == closing_type).alias("_closed")
    )
    start = F.unix_millis("due.start")
    return grouped.where("_closed").select(
        start.alias("start_time"), (start + size_ms - 1).alias("end_time"), "indexs"
    )


def merge_partial_maps(maps: DataFrame, keys: list[str], order: list[str], indicators: str = "indexs") -> DataFrame:
    """One map for each ``keys`` from any number of partial maps; of a type that several have, the
    last in ``order`` counts.

    Entries are merged one by one, so the maps of a key are combined before the exchange and in any
    grouping. Keys that have empty maps only get an empty map.
    """
    entries = maps.select(*keys, *order, F.explode_outer(indicators).alias("_type", "_n"))
    newest = entries.groupBy(*keys, "_type").agg(F.max_by("_n", F.struct(*order)).alias("_n"))
    listed = F.array_sort(F.collect_list(F.when(F.col("_type").isNotNull(), F.struct("_type", "_n"))))
    return newest.groupBy(*keys).agg(F.map_from_entries(listed).alias(indicators))


def merge_indicators(left: Column | str, right: Column | str) -> Column:
    """Union of two indicator maps with sorted keys; the right value wins."""
    merged = F.map_zip_with(
        as_column(left), as_column(right), lambda _, old, new: F.coalesce(new, old)
    )
    return F.map_from_entries(F.array_sort(F.map_entries(merged)))


def word_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """``time,word,word,...`` lines as one ``(ts, ms, word)`` event per word.

    Lines whose first field is no number are left out, see ``bad_word_lines``.
    """
    parts = compute_once(lines.select(value), "_f", split_fields(value, ","))
    timed = compute_once(parts, "ms", to_long(field(F.col("_f"), 0))).where("ms IS NOT NULL")
    rest = F.slice("_f", F.lit(2), F.size("_f"))
    return timed.select(event_time("ms").alias("ts"), "ms", F.explode(rest).alias("word"))


def bad_word_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    return lines.where(to_long(field(split_fields(value, ","), 0)).isNull())


def word_window_bounds(events: DataFrame, size_ms: int) -> DataFrame:
    """Words per window with the first and last event time seen, not the window bounds."""
    counted = events.groupBy(tumbling(size_ms).alias("window"), "word").agg(
        F.min("ms").alias("start_time"),
        F.max("ms").alias("end_time"),
        F.count(F.lit(1)).alias("count"),
    )
    return counted.select(
        F.unix_millis("window.start").alias("window_start"),
        "word",
        "start_time",
        "end_time",
        "count",
    )


def closed_windows(counts: DataFrame, newest_ms: int, size_ms: int, start: str = "window_start") -> DataFrame:
    """Windows a stream has emitted once it has seen an event at ``newest_ms``."""
    return counts.where(F.col(start) + size_ms <= newest_ms - MAX_OUT_OF_ORDER_MS)


def late_rows(
    log: DataFrame,
    source: str,
    order: list[str],
    blocks: list[dict[str, Column]],
    size_ms: int,
    delay_ms: int = MAX_OUT_OF_ORDER_MS,
) -> DataFrame:
    """Mark rows whose window had closed when they arrived.

    ``order`` is the arrival order within one log source and ``ms`` the event time. The
    watermark of a row is the newest event time before it less the delay.
    """
    seen = running_by_key(
        log, [source], order, blocks, {"_newest": ("max", F.col("ms"))}, include_current=False
    )
    watermark = F.col("_newest") - delay_ms
    closes = window_floor("ms", size_ms) + size_ms - 1
    return seen.select(
        *log.columns,
        watermark.alias("watermark"),
        F.coalesce(closes <= watermark, F.lit(False)).alias("late"),
    )
