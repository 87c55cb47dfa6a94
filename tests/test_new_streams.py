"""Stamped routes, delayed maps, running words, slow partitions, lenient times, map merges."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from helpers import SF, as_rows, column_of, drop_file
from tidegauge.functions.timeconv import parse_ms, parse_ms_lenient
from tidegauge.operators import counts, running, stamp, windows
from tidegauge.plans import inputs
from tidegauge.sources import logs
from tidegauge.streaming import jobs


def test_clock_stamps_differ_by_row_and_step(spark, tmp_path):
    for i in range(3):
        drop_file(f"{tmp_path}/in", f"f{i}.txt", ['{"idc":"al"}', "broken", '{"idc":"x"}'], i)
    lines = logs.text_stream(spark, f"{tmp_path}/in", 1, with_time=True)
    jobs.route_stamped(lines, f"{tmp_path}/clock", f"{tmp_path}/cp1").awaitTermination()
    jobs.route_stamped(lines, f"{tmp_path}/source", f"{tmp_path}/cp2", arrival=F.col("ms")).awaitTermination()
    for kind, least in (("clock", 1), ("source", 900_000)):
        back = jobs.stamped_lines(spark, f"{tmp_path}/{kind}")
        assert as_rows(back.groupBy("folder").count(), "folder", "count") == [("al", 3), ("json_err", 3), ("other", 3)]
        stamps = back.select(F.split("value", ",").alias("v")).select(F.col("v")[0].cast("long").alias("i"), F.col("v")[1].cast("long").alias("o"))
        assert stamps.where(f"o - i < {least}").count() == 0
        assert counts.mean_delay_per_second(back, "folder").agg(F.min("delay")).first()[0] >= least
    many = spark.range(0, 400_000, 1, 1).select(stamp.now_ms().alias("t"))
    assert many.distinct().count() > 1


def test_due_maps_need_no_python(spark):
    stream = jobs.stream_type_counts(inputs.interact_log(inputs.event_stream(spark, SF)), 600_000, 5)
    plan = windows.due_indicators(stream, 600_000)._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "TransformWithState" not in plan


def test_due_maps_wait(spark, tmp_path):
    def line(minute, other):
        fields = [f"2019-03-02 {7 + minute // 60:02d}:{minute % 60:02d}:00", "ip", "1300000007", "14000003", "4", "1", "1", "8", "9"]
        return "\t".join([*fields, f"luicode:10000408;insert_type:{'1' if other else '5'}"])

    sizes = []
    for i, batch in enumerate([[line(1, True), line(2, False), line(11, False)], [line(24, True)], [line(45, True)], [line(90, True)]]):
        drop_file(f"{tmp_path}/in", f"f{i}.txt", batch, i)
        out = windows.due_indicators(jobs.stream_type_counts(logs.text_stream(spark, f"{tmp_path}/in", 1), 600_000, 5), 600_000)
        jobs.append_files(out, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        got = spark.read.schema(out.schema).parquet(f"{tmp_path}/out")
        sizes.append(got.count())
    assert sizes == [0, 1, 2, 3]
    first = got.orderBy("start_time").first()
    assert first["indexs"] == {"fwd_5_0": 1, "other": 1} and first["end_time"] - first["start_time"] == 599_999


def test_running_words_over_many_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "STATE_EVERY", 3)
    rnd, rows = random.Random(4), []
    schema = "event_id BIGINT, pos INT, word STRING, in_time BIGINT"
    for batch in range(8):
        new = [(batch * 50 + i, 0, rnd.choice(["hot", "hot", "a", "b", None]), rnd.randrange(1000)) for i in range(40)]
        rows += new
        spark.createDataFrame(new, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = logs.table_stream(spark, f"{tmp_path}/in", schema=schema)
        jobs.running_words(stream, ["event_id", "pos"], running.id_blocks("event_id", 16, 400), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        if batch == 4:  # the last batch once more, as after a crash
            commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
            for path in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
                path.unlink(missing_ok=True)
            jobs.running_words(stream, ["event_id", "pos"], running.id_blocks("event_id", 16, 400), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    seen, expected = {}, []
    for event, pos, word, at in rows:
        newest, n = seen.get(word, (at, 0))
        # Words that are null are not joined with a state; each batch counts them anew.
        seen[word] = (max(newest, at), n + 1)
        expected.append((event, word, *seen[word]))
    got = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out/rows")
    assert as_rows(got.where("word IS NOT NULL"), "event_id", "word", "in_time", "count") == sorted(r for r in expected if r[1] is not None)
    assert (tmp_path / "out" / "whole").exists()


def test_a_hot_conversation_is_cut_into_ranges(spark, tmp_path):
    rows = [(c, t, "same word " * 3) for c in range(30) for t in range(2)] + [(12, 2 + t, "same thing") for t in range(400)]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, text STRING").repartition(4)

    def expand(ordered):
        return ordered.select("conv_id", "turn", F.posexplode(F.split(F.trim("text"), " ")).alias("pos", "word"))

    words = running.numbered_in_order(turns, ["conv_id", "turn"], str(tmp_path / "n"), expand)
    blocks = running.sorted_blocks("at", 5)
    cut = words.select("*", *[v.alias(n) for level in blocks for n, v in level.items()])
    assert cut.where("word = 'same'").groupBy("_at_far", "_at_near").count().agg(F.max("count")).first()[0] <= 32
    got = running.running_count(words, ["at"], blocks)
    expected = got.withColumn("n", F.expr("count(*) over (partition by word order by conv_id, turn, pos)"))
    assert got.count() == 30 * 2 * 6 + 800 and expected.where("n <> count").count() == 0


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    e = inputs.late_words(inputs.events(spark, SF))
    sliced, dropped = inputs.with_slice(e, "arrival"), 0
    for number in range(inputs.SLICES):
        inputs.add_slice(sliced, number, f"{tmp_path}/in")
        lines = logs.table_stream(spark, f"{tmp_path}/in", schema=e.schema)
        query = jobs.append_files(jobs.stream_word_windows(lines, 10_000), f"{tmp_path}/out", f"{tmp_path}/cp")
        query.awaitTermination()
        dropped += sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped > 0


def test_partition_that_is_silent_holds_windows_open(spark, tmp_path):
    schema = "ms BIGINT, word STRING"
    parts = [s.withColumn("ts", F.timestamp_millis("ms")) for s in logs.partition_streams(spark, f"{tmp_path}/in", "part", [0, 1], schema)]
    out = windows.word_window_bounds(windows.partition_watermarks(parts), 10_000)
    query = jobs.append_files(out, f"{tmp_path}/out", f"{tmp_path}/cp", interval="0 seconds")
    try:
        sizes = []
        for part, rows in ((0, [(1000, "a"), (50_000, "b")]), (1, [(2000, "a")]), (1, [(13_499, "c")]), (1, [(13_500, "c")])):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/part={part}")
            query.processAllAvailable()
            sizes.append(spark.read.schema(out.schema).parquet(f"{tmp_path}/out").count())
    finally:
        query.stop()
    assert sizes == [0, 0, 0, 1]
    assert as_rows(spark.read.schema(out.schema).parquet(f"{tmp_path}/out"), "word", "count", "start_time", "end_time") == [("a", 2, 1000, 2000)]


def test_lenient_times_equal_a_field_wise_parser(spark):
    rnd, texts, expected = random.Random(9), [], []
    for _ in range(400):
        y, mo, d = rnd.randrange(1, 3000), rnd.randrange(0, 40), rnd.randrange(0, 400)
        h, mi, s = rnd.randrange(0, 100), rnd.randrange(0, 1000), rnd.randrange(0, 5000)
        texts.append(f"{y}-{mo:0{rnd.choice([1, 2])}d}-{d} {h}:{mi:02d}:{s}" + rnd.choice(["", " tail", "\tx", ".5"]))
        months = y * 12 + mo - 1
        first = datetime(months // 12, months % 12 + 1, 1, tzinfo=timezone.utc) if months >= 12 else None
        if first is None:
            expected.append(None)
            continue
        at = first + timedelta(days=d - 1, hours=h, minutes=mi, seconds=s)
        expected.append((at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1))
    texts += ["", None, "2020-01-01", "x2020-1-1 1:1:1", "2020-1-1 1:1", "99999-1-1 1:1:1", "2020-1-1 1:1:12345678901"]
    expected += [None] * 7
    assert column_of(spark, texts, parse_ms_lenient("v")) == expected
    padded = ["2024-02-29 23:59:59", "1999-12-31 00:00:00 more"]
    assert column_of(spark, padded, parse_ms_lenient("v")) == column_of(spark, padded, parse_ms("v"))


def test_any_number_of_maps_is_merged(spark):
    rows = [(1, p, {"a": p, f"t{p}": 9} if p % 2 else {"a": p}) for p in range(7)] + [(2, 0, {}), (3, 5, {"x": None}), (3, 4, {"x": 1})]
    maps = spark.createDataFrame(rows, "start_time BIGINT, part BIGINT, indexs MAP<STRING,BIGINT>").repartition(5)
    merged = windows.merge_partial_maps(maps, ["start_time"], ["part"])
    got = {r["start_time"]: r["indexs"] for r in merged.collect()}
    assert got == {1: {"a": 6, "t1": 9, "t3": 9, "t5": 9}, 2: {}, 3: {"x": None}}
    assert merged.where("start_time = 1").select(F.map_keys("indexs")).first()[0] == ["a", "t1", "t3", "t5"]
