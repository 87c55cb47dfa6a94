"""Registered streaming queries: the events table read as a stream until it is used up.

Each query runs a checkpointed stream into the shared folder and returns what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.codec import indicator_json
from tidegauge.functions.timeconv import event_time
from tidegauge.operators import counts, running, stamp, windows
from tidegauge.plans import inputs
from tidegauge.plans.queries import DIGIT, SHORT_WINDOW_MS, WINDOW_MS, query
from tidegauge.session import shared_dir
from tidegauge.sinks import store
from tidegauge.sources.logs import partition_streams, table_stream
from tidegauge.streaming import jobs


PARTS = [0, 1, 2, 3]
HOUR_MS = 3_600_000


def _written(spark: SparkSession, stream: DataFrame, name: str, folders=()) -> DataFrame:
    """Run an append stream to its end and read its folder."""
    path = shared_dir(spark, name)
    jobs.append_files(stream, f"{path}/out", f"{path}/checkpoint", folders=folders).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def _interactions(spark, folder):
    return inputs.interact_log(inputs.event_stream(spark, folder))


@query
def word_window_closed(spark, folder):
    lines = inputs.word_lines(inputs.event_stream(spark, folder))
    return _written(spark, jobs.stream_word_windows(lines, SHORT_WINDOW_MS), "words")


@query
def stream_type_counts(spark, folder):
    counted = jobs.stream_type_counts(_interactions(spark, folder), WINDOW_MS, DIGIT)
    return _written(spark, counted.drop("window"), "types")


@query
def stream_indicator_map(spark, folder):
    maps = jobs.stream_indicators(_interactions(spark, folder), WINDOW_MS, DIGIT)
    text = indicator_json("start_time", "end_time", "indexs")
    return _written(spark, maps.select("start_time", text.alias("value")), "maps")


@query
def stream_indicator_due(spark, folder):
    counted = jobs.stream_type_counts(_interactions(spark, folder), WINDOW_MS, DIGIT)
    text = indicator_json("start_time", "end_time", "indexs")
    due = windows.due_indicators(counted, WINDOW_MS).select("start_time", text.alias("value"))
    return _written(spark, due, "due")


@query
def stream_indicator_store(spark, folder):
    path = shared_dir(spark, "realtime")
    job = jobs.realtime_indicators(
        _interactions(spark, folder), WINDOW_MS, DIGIT, path, f"{path}/checkpoint"
    )
    job.awaitTermination()
    return store.current(store.read_store(spark, f"{path}/store"))


@query
def stream_routes(spark, folder):
    records = inputs.json_log(inputs.event_stream(spark, folder)).select("event_id", "value")
    path = shared_dir(spark, "routes")
    jobs.route_files(records, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    back = spark.read.schema("event_id BIGINT, value STRING, route STRING").parquet(f"{path}/out")
    return back.select("event_id", "route")


@query
def stream_copy(spark, folder):
    lines = inputs.event_stream(spark, folder).select(F.col("props").alias("value"))
    return _written(spark, stamp.copy_lines(lines), "copy")


@query
def stream_word_totals(spark, folder):
    lines = inputs.word_lines(inputs.event_stream(spark, folder))
    totals = running.latest_totals(running.csv_words(lines, ["in_time"]))
    path = shared_dir(spark, "totals")
    jobs.latest_per_key(totals, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    schema = "word STRING, in_time BIGINT, count BIGINT, batch BIGINT"
    changes = spark.read.schema(schema).parquet(f"{path}/out")
    newest = changes.groupBy("word").agg(F.max_by(F.struct("in_time", "count"), "batch").alias("_v"))
    return newest.select("word", "_v.*")


def _in_slices(spark, rows, by, name, job):
    """Feed a table to a stream in slices of ``by``, and start the stream again for each.

    ``job(path, base, checkpoint)`` starts it; every start but the first resumes from the checkpoint.
    Returns the folder that the job writes to.
    """
    path = shared_dir(spark, name)
    sliced = inputs.with_slice(rows, by)
    for number in range(inputs.SLICES):
        inputs.add_slice(sliced, number, f"{path}/in")
        job(f"{path}/in", f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return f"{path}/out"


@query
def stream_word_running(spark, folder):
    """Running reduce of a stream that stops and resumes, one row for every word."""
    words = running.csv_words(inputs.word_lines(inputs.events(spark, folder)), ["event_id", "in_time"])
    blocks = running.id_blocks("event_id", most=inputs.table(spark, folder, "events").agg(F.max("event_id")).first()[0] or 0)

    def job(path, base, checkpoint):
        stream = table_stream(spark, path, schema=words.schema)
        return jobs.running_words(stream, ["event_id", "pos"], blocks, base, checkpoint)

    base = _in_slices(spark, words, "event_id", "running", job)
    schema = "event_id BIGINT, pos INT, word STRING, in_time BIGINT, count BIGINT"
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/rows")


@query
def stream_late_words(spark, folder):
    """Words per window of rows that arrive out of order; the stream is stopped and resumed between."""
    log = inputs.late_words(inputs.events(spark, folder))

    def job(path, base, checkpoint):
        lines = table_stream(spark, path, schema=log.schema)
        return jobs.append_files(jobs.stream_word_windows(lines, SHORT_WINDOW_MS), base, checkpoint)

    base = _in_slices(spark, log, "arrival", "late", job)
    schema = "window_start BIGINT, word STRING, start_time BIGINT, end_time BIGINT, count BIGINT"
    return spark.read.schema(schema).parquet(base)


@query
def stream_time_buckets(spark, folder):
    """Rows of the hours that are complete, from a stream with late rows that stops and resumes."""
    log = inputs.late_events(inputs.events(spark, folder))

    def job(path, base, checkpoint):
        rows = table_stream(spark, path, schema=log.schema)
        return jobs.bucket_files(rows, HOUR_MS, base, checkpoint)

    base = _in_slices(spark, log, "arrival", "hours", job)
    return jobs.closed_buckets(spark, base, "event_id BIGINT, arrival BIGINT, ms BIGINT").select("event_id", "bucket")


@query
def stream_slow_partition(spark, folder):
    """Types per window of four log partitions, the last of which stops halfway and holds windows open."""
    e = inputs.events(spark, folder).select("ms", F.col("event_type").alias("type"), (F.col("user_id") % 4).cast("int").alias("part"))
    arrived = inputs.with_slice(e, "ms").where("part <> 3 OR slice < 2")
    path = shared_dir(spark, "slow")
    parts = [s.withColumn("ts", event_time("ms")) for s in partition_streams(spark, f"{path}/in", "part", PARTS, "ms BIGINT, type STRING, slice INT")]
    counted = windows.window_counts(windows.partition_watermarks(parts), SHORT_WINDOW_MS).drop("window")
    # It runs on while rows arrive, as a partition's newest time is known to a running query only.
    job = jobs.append_files(counted, f"{path}/out", f"{path}/checkpoint", interval="2 seconds")
    try:
        for number in range(inputs.SLICES):
            inputs.add_slice_whole(arrived, number, path, "part", PARTS)
            job.processAllAvailable()
    finally:
        job.stop()
    return spark.read.schema(counted.schema).parquet(f"{path}/out")


@query
def stream_route_delays(spark, folder):
    """Rows and mean delay per second and route folder, from a stream that stamps and routes."""
    log = inputs.json_log(inputs.events(spark, folder))

    def job(path, base, checkpoint):
        records = table_stream(spark, path, schema=log.schema)
        return jobs.route_stamped(records, base, checkpoint, arrival=F.col("in_time"), departure=F.col("out_time"))

    lines = jobs.stamped_lines(spark, _in_slices(spark, log, "event_id", "delays", job))
    seconds = counts.per_second_counts(lines, "folder")
    return seconds.join(counts.mean_delay_per_second(lines, "folder"), ["folder", "key"])
