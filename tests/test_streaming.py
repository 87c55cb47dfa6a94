"""Streams against their table twins, at the watermark's edges, and across restarts."""

import pytest
from pyspark.sql import functions as F

from helpers import SF, as_rows, drop_file
from tidegauge.functions.codec import indicator_json
from tidegauge.operators import classify, route, running, windows
from tidegauge.plans import inputs
from tidegauge.sinks import store
from tidegauge.sources import logs
from tidegauge.streaming import jobs
from tidegauge.streaming.running import running_totals
from tidegauge.streaming.timers import due_indicators

WINDOW_MS = 600_000
COUNTS = ("window_start", "word", "start_time", "end_time", "count")


class WordStream:
    """A folder of word lines and the windows emitted from it so far."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, str(folder), 0

    def feed(self, *lines):
        self.files += 1
        drop_file(f"{self.folder}/in", f"f{self.files}.txt", lines, self.files)
        return self.run()

    def run(self):
        lines = logs.text_stream(self.spark, f"{self.folder}/in", files_per_batch=1)
        out = jobs.stream_word_windows(lines, 10_000)
        jobs.append_files(out, f"{self.folder}/out", f"{self.folder}/cp").awaitTermination()
        return as_rows(self.spark.read.schema(out.schema).parquet(f"{self.folder}/out"), *COUNTS)


def test_window_closes_when_the_watermark_reaches_its_end(spark, tmp_path):
    stream = WordStream(spark, tmp_path)
    assert stream.feed("1000,a,b", "13499,z") == []
    assert stream.feed("13500,z") == [(0, "a", 1000, 1000, 1), (0, "b", 1000, 1000, 1)]


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    stream = WordStream(spark, tmp_path)
    stream.feed("1000,a,a")
    stream.feed("2000,a", "bad,line")
    assert stream.run() == []
    closed = stream.feed("40000,z")
    assert closed == [(0, "a", 1000, 2000, 3)]
    assert stream.run() == closed
    assert stream.feed("80000,z") == closed + [(40000, "z", 40000, 40000, 1)]


def test_late_rows_are_dropped_once_the_window_is_gone(spark, tmp_path):
    stream = WordStream(spark, tmp_path)
    stream.feed("1000,a")
    stream.feed("30000,z")
    assert stream.feed("2000,a", "60000,z") == [(0, "a", 1000, 1000, 1), (30000, "z", 30000, 30000, 1)]


@pytest.fixture(scope="module")
def line_files(spark, tmp_path_factory):
    """The interaction and word lines of the events table as four text files each."""
    folder = tmp_path_factory.mktemp("lines")
    events = inputs.events(spark, SF)
    for name, lines in (("log", inputs.interact_log(events)), ("words", inputs.word_lines(events))):
        rows = [r["value"] for r in lines.orderBy("event_id").collect()]
        step = -(-len(rows) // 4)
        for i in range(4):
            drop_file(str(folder / name), f"f{i}.txt", rows[i * step : (i + 1) * step], i)
    return folder


def closed(df, newest, start="start_time"):
    return windows.closed_windows(df, newest, WINDOW_MS, start)


def table_counts(spark, line_files):
    lines = logs.text_lines(spark, str(line_files / "log"))
    events = classify.interaction_events(lines, 5)
    newest = events.agg(F.max("ms")).first()[0]
    return windows.window_counts(events, WINDOW_MS), newest, events.count()


def test_type_counts_match_the_table(spark, line_files, tmp_path):
    table, newest, n = table_counts(spark, line_files)
    assert table.agg(F.sum("count")).first()[0] == n
    lines = logs.text_stream(spark, str(line_files / "log"), files_per_batch=1)
    out = jobs.stream_type_counts(lines, WINDOW_MS, 5).drop("window")
    jobs.append_files(out, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    columns = ("start_time", "end_time", "type", "count")
    got = as_rows(spark.read.parquet(f"{tmp_path}/out"), *columns)
    assert got == as_rows(closed(table, newest), *columns) and got


def test_realtime_job_fills_all_three_targets(spark, line_files, tmp_path):
    table, newest, _ = table_counts(spark, line_files)
    base = str(tmp_path / "job")
    lines = logs.text_stream(spark, str(line_files / "log"), files_per_batch=2)
    jobs.realtime_indicators(lines, WINDOW_MS, 5, base, f"{base}/cp").awaitTermination()
    maps = closed(windows.window_indicators(table, WINDOW_MS), newest)
    expected = as_rows(maps.select(indicator_json("start_time", "end_time", "indexs").alias("v")), "v")
    assert as_rows(spark.read.parquet(f"{base}/total"), "value") == expected and expected
    assert as_rows(store.current(store.read_store(spark, f"{base}/store")), "value") == expected
    assert spark.read.parquet(f"{base}/mul").count() == closed(table, newest).count()


def test_due_maps_wait_and_need_the_closing_type(spark, tmp_path):
    def line(minute, other):
        uid, insert = "1300024510", "1" if other else "5"
        fields = [f"2021-03-14 {16 + minute // 60}:{minute % 60:02d}:00", "ip", uid, "14000003", "4", "1", "1", "8", "9",
                  f"luicode:10000408;insert_type:{insert}"]
        return "\t".join(fields)

    folder = str(tmp_path)
    collected = None
    batches = [
        [line(1, True), line(2, False), line(11, False)],  # window :10 has no "other"
        [line(24, True)],
        [line(45, True)],
        [line(90, True)],
    ]
    sizes = []
    for i, batch in enumerate(batches):
        drop_file(f"{folder}/in", f"f{i}.txt", batch, i)
        counts = jobs.stream_type_counts(logs.text_stream(spark, f"{folder}/in", 1), WINDOW_MS, 5)
        out = due_indicators(counts, WINDOW_MS)
        jobs.append_files(out, f"{folder}/out", f"{folder}/cp").awaitTermination()
        collected = spark.read.schema(out.schema).parquet(f"{folder}/out")
        sizes.append(collected.count())
    # Window :00 ends 16:09:59.999 and is due ten minutes of event time later.
    assert sizes == [0, 1, 2, 3]
    first = collected.orderBy("start_time").first()
    assert first["indexs"] == {"fwd_5_2": 1, "other": 1}
    assert first["end_time"] - first["start_time"] == WINDOW_MS - 1


def test_route_files(spark, tmp_path):
    records = inputs.json_log(inputs.event_stream(spark, SF)).select("event_id", "value")
    jobs.route_files(records, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    table = route.with_route(inputs.json_log(inputs.events(spark, SF)))
    back = spark.read.parquet(f"{tmp_path}/out")
    assert as_rows(back, "event_id", "route") == as_rows(table, "event_id", "route")
    assert {r["route"] for r in back.select("route").distinct().collect()} == set(classify_routes())


def classify_routes():
    return [*route.NAMED_ROUTES, route.OTHER_ROUTE, route.ERROR_ROUTE]


def test_running_totals_in_update_mode(spark, tmp_path):
    folder = str(tmp_path)
    for i, lines in enumerate((["a,b,a"], ["a,c"])):
        drop_file(f"{folder}/in", f"f{i}.txt", lines, i)
    lines = logs.text_stream(spark, f"{folder}/in", 1).withColumn("in_time", F.lit(9).cast("bigint"))
    totals = running.latest_totals(running.csv_words(lines, ["in_time"]))
    jobs.latest_per_key(totals, f"{folder}/out", f"{folder}/cp").awaitTermination()
    changes = as_rows(spark.read.parquet(f"{folder}/out"), "batch", "word", "count")
    assert changes == [(0, "a", 2), (0, "b", 1), (1, "a", 3), (1, "c", 1)]


def test_merge_of_indicator_maps(spark):
    rows = [({"fwd": 12}, {"cmt": 14, "lk": 15}), ({"b": 1, "a": 2}, {"b": 9}), ({}, {})]
    df = spark.createDataFrame(rows, "l MAP<STRING,BIGINT>, r MAP<STRING,BIGINT>")
    got = [r["m"] for r in df.select(windows.merge_indicators("l", "r").alias("m")).collect()]
    assert got == [{"cmt": 14, "fwd": 12, "lk": 15}, {"a": 2, "b": 9}, {}]
    keys = df.select(F.map_keys(windows.merge_indicators("l", "r")).alias("k")).first()["k"]
    assert keys == ["cmt", "fwd", "lk"]


def test_merge_is_associative(spark):
    maps = "map('a', 1L, 'b', 2L) x, map('b', 3L) y, map('a', 5L, 'c', 4L) z"
    df = spark.sql(f"SELECT {maps}")
    left = windows.merge_indicators(windows.merge_indicators("x", "y"), "z")
    right = windows.merge_indicators("x", windows.merge_indicators("y", "z"))
    assert tuple(df.select(left, right).first()) == ({"a": 5, "b": 3, "c": 4},) * 2


def test_every_row_gets_its_running_total(spark, tmp_path):
    folder = str(tmp_path)
    for i, lines in enumerate((["5,a", "7,b", "4,a"], ["3,a", "9,a"])):
        drop_file(f"{folder}/in", f"f{i}.txt", lines, i)
    lines = logs.text_stream(spark, f"{folder}/in", 1)
    words = lines.select(
        F.split_part("value", F.lit(","), F.lit(1)).cast("bigint").alias("in_time"),
        F.split_part("value", F.lit(","), F.lit(2)).alias("word"),
    )
    expected = [("a", 1, 5), ("a", 2, 5), ("a", 3, 5), ("a", 4, 9), ("b", 1, 7)]
    jobs.append_files(running_totals(words), f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert as_rows(spark.read.parquet(f"{folder}/out"), "word", "count", "in_time") == expected

    # Forgetting by wall clock needs a stream that keeps running.
    totals = running_totals(words, 3_600_000)
    query = jobs.append_files(totals, f"{folder}/ttl", f"{folder}/cp-ttl", interval="1 second")
    try:
        for _ in range(40):
            query.awaitTermination(1)
            if sum(p.numInputRows for p in query.recentProgress) >= 5:
                break
    finally:
        query.stop()
    assert as_rows(spark.read.parquet(f"{folder}/ttl"), "word", "count", "in_time") == expected


def test_ingestion_time_and_console(spark, tmp_path):
    drop_file(f"{tmp_path}/in", "f.txt", ["x", "y"], 0)
    stamped = windows.with_ingestion_time(logs.text_stream(spark, f"{tmp_path}/in"))
    counts = windows.with_watermark(stamped, 0).groupBy(windows.tumbling(10_000)).count()
    jobs.print_rows(counts, f"{tmp_path}/cp", mode="update").awaitTermination()
    table = windows.with_ingestion_time(logs.text_lines(spark, f"{tmp_path}/in"))
    row = table.first()
    assert row["ms"] > 1_600_000_000_000 and int(row["ts"].timestamp() * 1_000) // 10 == row["ms"] // 10


def test_windows_without_the_closing_type_are_forgotten(spark, tmp_path):
    """State holds the open windows only, also those that never emit."""
    from tidegauge.streaming.timers import due_indicators

    for i in range(6):
        drop_file(f"{tmp_path}/in", f"f{i}.txt", [str(i * 10_000), str(i * 10_000 + 1)], i)
    lines = logs.text_stream(spark, f"{tmp_path}/in", 1)
    stamped = lines.select(F.timestamp_millis(F.col("value").cast("bigint")).alias("ts"), F.lit("fwd").alias("type"))
    counts = windows.with_watermark(stamped, 0).groupBy(F.window("ts", "10 seconds"), "type").agg(F.count("*").alias("count"))
    counts = counts.withColumn("start_time", F.unix_millis("window.start"))
    query = jobs.append_files(due_indicators(counts, 10_000, 0), f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination()
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 2
