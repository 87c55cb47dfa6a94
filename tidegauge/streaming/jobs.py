"""Streaming jobs: the table operators between a stream source and a checkpointed sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegauge.functions.codec import count_json, csv_line, indicator_json
from tidegauge.functions.timeconv import window_floor
from tidegauge.operators.classify import interaction_events
from tidegauge.operators.route import with_route
from tidegauge.operators.running import carried_on, latest_totals, running_reduce
from tidegauge.operators.stamp import stamp_arrival, stamp_departure
from tidegauge.operators.windows import (
    MAX_OUT_OF_ORDER_MS,
    window_counts,
    window_indicators,
    with_watermark,
    word_events,
    word_window_bounds,
)
from tidegauge.sinks.files import batch_folder, fan_out, route_folder
from tidegauge.sinks.folders import Folders, partition_folder
from tidegauge.sinks.store import store_writer


def start(
    writer: DataStreamWriter, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start a stream that resumes from its checkpoint folder after any stop.

    ``interval`` such as ``5 seconds`` keeps it running; without one it handles what is
    there and ends.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def append_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    fmt: str = "parquet",
    folders: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append a stream to one folder, or to one folder per value of ``folders``, exactly once."""
    writer = stream.writeStream.format(fmt).option("path", path).outputMode("append")
    if folders:
        writer = writer.partitionBy(*folders)
    return start(writer, checkpoint, interval)


def stream_type_counts(lines: DataFrame, size_ms: int, digit: int) -> DataFrame:
    """Interaction lines to counts per type and closed window."""
    return window_counts(with_watermark(interaction_events(lines, digit)), size_ms)


def stream_indicators(lines: DataFrame, size_ms: int, digit: int) -> DataFrame:
    """Interaction lines to one indicator map per closed window (two chained aggregations)."""
    return window_indicators(stream_type_counts(lines, size_ms, digit), size_ms)


def stream_word_windows(lines: DataFrame, size_ms: int) -> DataFrame:
    """Word lines to words per closed window with the event times seen."""
    return word_window_bounds(with_watermark(word_events(lines)), size_ms)


def realtime_indicators(
    lines: DataFrame,
    size_ms: int,
    digit: int,
    base: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """The whole indicator job: counts to ``mul``, maps to ``total`` and to ``store``.

    A micro-batch emits a window for all its types at once, so the map of a window is built
    from the batch itself and the stream keeps a single state.
    """

    def count_texts(batch: DataFrame) -> DataFrame:
        return batch.select(count_json("start_time", "end_time", "type", "count").alias("value"))

    def map_texts(batch: DataFrame) -> DataFrame:
        return window_indicators(batch, size_ms).select(indicator_json("start_time", "end_time", "indexs").alias("value"))

    def maps_to_both(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch_folder(f"{base}/total"), store_writer(f"{base}/store"))(map_texts(batch), batch_id)

    targets = fan_out(batch_folder(f"{base}/mul", count_texts), maps_to_both)
    counts = stream_type_counts(lines, size_ms, digit)
    return start(counts.writeStream.foreachBatch(targets), checkpoint, interval)


def route_stamped(
    records: DataFrame,
    base: str,
    checkpoint: str,
    interval: str | None = None,
    arrival: Column | None = None,
    departure: Column | None = None,
) -> StreamingQuery:
    """Route JSON records and measure how long that takes: ``in,out,value`` lines, one folder per
    micro-batch and route.

    ``arrival`` is the time the source gives a record (of a Kafka record or a file, see ``logs``), or the clock
    when the row is read. The rows are kept before they are written, and ``departure`` is the clock at
    the writer then. ``counts.per_second_counts`` and ``mean_delay_per_second`` read the folders back.
    """
    arrived = stamp_arrival(records, arrival)
    given = [departure.alias("_departure")] if departure is not None else []
    routed = with_route(arrived.select("in_time", "value", *given))

    def write(batch: DataFrame, batch_id: int) -> None:
        leaving = stamp_departure(batch, F.col("_departure") if given else None)
        lines = leaving.select(csv_line("in_time", "out_time", "value").alias("value"), route_folder("route").alias("folder"))
        lines.write.mode("overwrite").partitionBy("folder").text(f"{base}/batch={batch_id}")

    return start(routed.writeStream.foreachBatch(fan_out(write)), checkpoint, interval)


def stamped_lines(spark: SparkSession, base: str) -> DataFrame:
    """``(value, folder)`` of all micro-batches of ``route_stamped``."""
    return spark.read.schema("value STRING, batch BIGINT, folder STRING").format("text").load(base).select("value", "folder")


# A whole state is written again after so many micro-batches, and changes in between.
STATE_EVERY = 16


def running_words(
    words: DataFrame,
    order: list[str],
    blocks: list[dict[str, Column]],
    base: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """For every ``(word, in_time)`` row of a stream the newest time and the number of its word so far.

    State has two levels. A micro-batch cuts its rows of a word into ranges of ``order``, each scanned
    by a task of its own from what the ranges before add up to, as ``running_by_key`` does; the
    sums of all batches before it are joined by word. They lie in ``base``: each batch adds the
    sums of its words, and every STATE_EVERY-th all of them, so a batch reads a few folders.
    A repeated batch reads what it read before and replaces what it wrote. Rows go to ``base/rows``.
    """
    spark = words.sparkSession
    schema = "word STRING, in_time BIGINT, count BIGINT"

    def summed(first: int, last: int) -> DataFrame:
        """Sums of the batches before ``last``: the whole state at ``first`` and the changes since."""
        there = Folders(spark, base)
        names = [f"whole/batch={first}", *(f"sums/batch={i}" for i in range(first, last))]
        parts = [f"{base}/{name}" for name in names if there.exists(name)]
        old = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
        return old.groupBy("word").agg(F.max("in_time").alias("in_time"), F.sum("count").alias("count"))

    def write(batch: DataFrame, batch_id: int) -> None:
        whole = batch_id - batch_id % STATE_EVERY
        if batch_id and batch_id == whole:
            summed(whole - STATE_EVERY, whole).write.mode("overwrite").parquet(f"{base}/whole/batch={whole}")
        totals_before = summed(whole, batch_id)
        running = carried_on(totals_before, running_reduce(batch, order, blocks))
        running.write.mode("overwrite").parquet(f"{base}/rows/batch={batch_id}")
        latest_totals(batch).write.mode("overwrite").parquet(f"{base}/sums/batch={batch_id}")

    return start(words.writeStream.foreachBatch(fan_out(write)), checkpoint, interval)


TIME_BUCKETS = "bucket STRING, start BIGINT, newest BIGINT"


def bucket_files(
    records: DataFrame,
    size_ms: int,
    base: str,
    checkpoint: str,
    interval: str | None = None,
    pattern: str = "yyyy-MM-dd--HH",
    delay_ms: int = MAX_OUT_OF_ORDER_MS,
) -> StreamingQuery:
    """Write a stream to one folder per time bucket of ``ms``, and mark the buckets that are complete.

    ``pattern`` names buckets of ``size_ms`` apart. A micro-batch is judged by the watermark that all batches
    before it have left, ``delay_ms`` behind the newest time: rows whose bucket it has passed, and rows
    without a time, go to ``base/late``. Once a batch is written, the buckets that its own watermark passes
    are marked in ``base/closed`` and get no more rows. Open buckets and the newest time are carried
    from batch to batch in ``base/state``. A repeated batch reads what it read before, replaces what it wrote and
    sets the same marks, so a stop at any point loses and doubles nothing.
    """
    spark = records.sparkSession
    start_ms = window_floor("ms", size_ms)

    def write(batch: DataFrame, batch_id: int) -> None:
        folders = Folders(spark, base)
        before = f"state/batch={batch_id - 1}"
        known = folders.exists(before)
        old = spark.read.schema(TIME_BUCKETS).parquet(f"{base}/{before}") if known else spark.createDataFrame([], TIME_BUCKETS)
        passed = old.agg(F.max("newest") - delay_ms).first()[0]
        timed = batch.withColumns({"bucket": F.date_format(F.timestamp_millis(start_ms), pattern), "batch": F.lit(batch_id)})
        late = F.col("ms").isNull() | F.coalesce(start_ms + size_ms <= F.lit(passed).cast("bigint"), F.lit(False))
        timed.where(late).drop("bucket", "batch").write.mode("overwrite").parquet(f"{base}/late/batch={batch_id}")
        on_time = timed.where(~late)
        on_time.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{base}/rows")

        seen = on_time.groupBy("bucket", start_ms.alias("start")).agg(F.max("ms").alias("newest"))
        both = old.unionByName(seen).groupBy("bucket", "start").agg(F.max("newest").alias("newest"))
        newest = both.agg(F.max("newest")).first()[0]
        over = F.coalesce(F.col("start") + size_ms <= F.lit(newest).cast("bigint") - delay_ms, F.lit(False))
        # Names of the buckets that close with this batch, which are as many as there are folders to mark.
        for row in both.where(over).select("bucket").distinct().collect():
            folders.mark(f"closed/{row['bucket']}")
        clock = spark.range(1).select(F.lit(None).cast("string").alias("bucket"), F.lit(None).cast("bigint").alias("start"), F.lit(newest).cast("bigint").alias("newest"))
        still = both.where(~over & F.col("start").isNotNull()).unionByName(clock)
        still.coalesce(1).write.mode("overwrite").parquet(f"{base}/state/batch={batch_id}")
        if batch_id > 1:
            folders.drop(f"state/batch={batch_id - 2}")

    return start(records.writeStream.foreachBatch(fan_out(write)), checkpoint, interval)


def closed_buckets(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """Rows of the complete buckets of ``bucket_files`` with their ``bucket``; folders of open ones are not opened.

    ``schema`` is that of the stream's rows. Without a complete bucket there are no rows.
    """
    marks = Folders(spark, base).names("closed")
    if not marks:
        return spark.createDataFrame([], f"{schema}, bucket STRING")
    paths = [f"{base}/rows/{partition_folder('bucket', name)}" for name in marks]
    return spark.read.schema(f"{schema}, bucket STRING, batch BIGINT").option("basePath", f"{base}/rows").parquet(*paths).drop("batch")


def route_files(
    records: DataFrame, base: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Route JSON records into one folder per route, in one pass over the stream."""
    return append_files(with_route(records), base, checkpoint, interval, folders=("route",))


def print_rows(
    stream: DataFrame, checkpoint: str, interval: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Print results of a stream on the driver's console, for a look at small results."""
    return start(stream.writeStream.format("console").outputMode(mode), checkpoint, interval)


def latest_per_key(
    totals: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Write every change of a keyed running aggregate, one folder per micro-batch."""
    writer = totals.writeStream.outputMode("update").foreachBatch(batch_folder(path))
    return start(writer, checkpoint, interval)
