import json
import os
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import as_rows, values
from tidegauge.operators import counts
from tidegauge.session import build_session, prepare, shared_dir
from tidegauge.sinks import files, store
from tidegauge.sinks.folders import Folders
from tidegauge.sources import logs


def test_measure_files_in_one_scan(spark, tmp_path):
    for tm, ts, lines in ((1, 4, ["k 10", "k 21"]), (4, 16, ["k\t7"])):
        (tmp_path / f"throughput_{tm}_{ts}.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "notes.txt").write_text("k 1\n")
    got = counts.mean_by_config(logs.measure_files(spark, str(tmp_path)))
    assert as_rows(got, "tm_num", "ts_num", "count", "throughput") == [(1, 4, 2, 15), (4, 16, 1, 7)]


def test_kafka_options():
    got = logs.kafka_options("host:1", topic="t", start="earliest")
    assert got == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "t",
        "startingOffsets": "earliest", "failOnDataLoss": "true",
    }
    assert logs.kafka_options("h", pattern="t.*", fail_on_loss=False)["subscribePattern"] == "t.*"
    assert logs.kafka_options("h", topic="t", start="group")["startingOffsets"] == "latest"
    ranged = logs.kafka_options("h", topic="t", start={"t": {"0": 5}}, end={"t": {"0": 9}})
    assert json.loads(ranged["startingOffsets"]) == {"t": {"0": 5}}
    assert json.loads(ranged["endingOffsets"]) == {"t": {"0": 9}}
    for bad in ({}, {"topic": "t", "pattern": "p"}, {"topic": "t", "start": "middle"}):
        with pytest.raises(ValueError):
            logs.kafka_options("h", **bad)


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        logs.kafka_stream(spark, servers="h", topic="t")


def test_line_source_kinds(spark, tmp_path):
    assert logs.line_source(spark, "text", path=str(tmp_path)).isStreaming
    with pytest.raises(ValueError):
        logs.line_source(spark, "queue")


def test_keyed_text_is_sorted_within_files(spark, tmp_path):
    path = str(tmp_path / "out")
    result = spark.range(50).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("n"))
    files.write_keyed_text(result.repartition(3), path, "key", "n")
    seen = 0
    for name in os.listdir(path):
        if name.startswith("part-"):
            pairs = [line.split("\t") for line in open(os.path.join(path, name)).read().splitlines()]
            assert pairs == sorted(pairs) and all(int(n) == 2 * int(k) for k, n in pairs)
            seen += len(pairs)
    assert seen == 50


def test_lines_are_appended_unquoted(spark, tmp_path):
    path = str(tmp_path / "out")
    for text in ('a,"b"', "c\td"):
        files.append_lines(values(spark, [text]), path)
    assert as_rows(logs.text_lines(spark, path), "value") == [('a,"b"',), ("c\td",)]


def test_bucketed_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "out")
    lines = values(spark, ['1,tag,4,16,{"a":1,"b":2}', "2,tag,1,4,x", "3,tag,4,16,y"])
    assert as_rows(lines.select(files.bucket_path("base").alias("p")).distinct(), "p") == [
        ("base/1/4/data",), ("base/4/16/data",)
    ]
    files.write_bucketed(lines.select("value", *[c.alias(n) for n, c in files.bucket_fields().items()]), path, "tm_num", "ts_num")
    back = spark.read.parquet(path).where("tm_num = 4 AND ts_num = 16")
    assert back.count() == 2
    assert "PartitionFilters: [isnotnull(tm_num" in back._jdf.queryExecution().executedPlan().toString()


def test_time_buckets_and_route_folders(spark):
    df = spark.createDataFrame([(1526700293637, "json_error")], "ms BIGINT, route STRING")
    got = files.with_time_bucket(df).select("bucket", files.route_folder().alias("folder")).first()
    assert tuple(got) == ("2018-05-19--03", "json_err")
    assert files.versioned_base("base", "2") == "base/ver2/data"


def test_kafka_columns(spark):
    plain = files.kafka_columns(values(spark, ["x"]), "t")
    assert [tuple(r) for r in plain.collect()] == [("x", "t")]
    numbered = values(spark, ["x"]).withColumn("partition", F.lit(3).cast("bigint"))
    got = files.kafka_columns(numbered, "t", files.record_json("value"))
    assert got.dtypes == [("value", "string"), ("topic", "string"), ("partition", "int")]
    assert tuple(got.first()) == ('{"value":"x"}', "t", 3)


def result_json(start, text="x"):
    return f'{{"start_time":"{start}","end_time":"z","indexs":{{"{text}":"1"}}}}'


def test_store_keeps_the_newest_value(spark, tmp_path):
    path = str(tmp_path / "store")
    first = values(spark, [result_json("2018-06-11 03:10:00", "old"), result_json("2018-06-12 00:00:00")])
    store.put(store.keyed_rows(first), path, 0)
    store.put(store.keyed_rows(first), path, 0)
    store.put(store.keyed_rows(values(spark, [result_json("2018-06-11 03:10:00", "new")])), path, 1)
    store.put_one(spark, path, 2, "experimental_results", "notes", 1528084116, "hello")
    stored = store.current(store.read_store(spark, path))
    assert stored.count() == 3

    got = store.get(spark, path, "experimental_results", "realtime_index_count", 1528686600)
    assert got.first()["value"] == result_json("2018-06-11 03:10:00", "new")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "period" in plan.split("PartitionFilters")[1].split("]")[0]
    assert store.get(spark, path, "experimental_results", "notes", 1528084116).first()["value"] == "hello"
    assert store.get(spark, path, "experimental_results", "notes", 1).count() == 0

    wanted = spark.createDataFrame(
        [("experimental_results", "realtime_index_count", t) for t in (1528686600, 1528761600, 5)],
        "business STRING, key_id STRING, timestamp BIGINT",
    )
    assert store.get_many(store.read_store(spark, path), wanted).count() == 2

    before = as_rows(stored, "business", "key_id", "timestamp", "value")
    period = 1528686600 // store.PERIOD_SECONDS
    store.compact(spark, path, "experimental_results", "realtime_index_count", period)
    after = store.read_store(spark, path)
    assert as_rows(store.current(after), "business", "key_id", "timestamp", "value") == before
    # The newest batch stays as it is, and all before it is one snapshot.
    assert as_rows(after.where(f"key_id = 'realtime_index_count' AND period = {period}").select("batch").distinct(), "batch") == [(-1,), (1,)]


def numbers(spark, *pairs):
    return spark.createDataFrame([("b", "k/1", t, v) for t, v in pairs], "business STRING, key_id STRING, timestamp BIGINT, value STRING")


def stored_values(spark, path):
    return as_rows(store.current(store.read_store(spark, path)), "timestamp", "value")


def test_a_batch_repeated_after_compaction_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    store.put(numbers(spark, (1, "a"), (2, "b"), (4, "d")), path, 0)
    store.put(numbers(spark, (3, "c"), (2, "B")), path, 1)
    expected = [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    for _ in range(2):
        store.compact(spark, path, "b", "k/1", 0)
        assert stored_values(spark, path) == expected
        store.put(numbers(spark, (3, "c"), (2, "B")), path, 1)
        assert stored_values(spark, path) == expected
    store.put(numbers(spark, (4, "D")), path, 2)
    store.put(numbers(spark, (1, "A")), path, 3)
    store.compact(spark, path, "b", "k/1", 0)
    expected = [(1, "A"), (2, "B"), (3, "c"), (4, "D")]
    assert stored_values(spark, path) == expected
    # Snapshot of batches 0 to 2, and the newest batch; a late repeat of an old one changes nothing either.
    assert [r[0] for r in as_rows(store.read_store(spark, path).select("batch").distinct(), "batch")] == [-3, 3]
    store.put(numbers(spark, (3, "c"), (2, "B")), path, 1)
    assert stored_values(spark, path) == expected


def test_compaction_that_stopped_halfway(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    for i in range(4):
        store.put(numbers(spark, (1, f"v{i}"), (i + 10, "x")), path, i)
    expected = stored_values(spark, path)
    monkeypatch.setattr(Folders, "drop", lambda self, name: None)
    store.compact(spark, path, "b", "k/1", 0)
    assert stored_values(spark, path) == expected
    monkeypatch.undo()
    store.compact(spark, path, "b", "k/1", 0)
    assert stored_values(spark, path) == expected
    assert [r[0] for r in as_rows(store.read_store(spark, path).select("batch").distinct(), "batch")] == [-3, 3]


def test_an_unfinished_batch_is_not_compacted(spark, tmp_path):
    path = str(tmp_path / "store")
    for i in range(4):
        store.put(numbers(spark, (1, f"v{i}")), path, i)
    Folders(spark, path).drop("_log/1.done")
    store.compact(spark, path, "b", "k/1", 0)
    assert [r[0] for r in as_rows(store.read_store(spark, path).select("batch").distinct(), "batch")] == [-1, 1, 2, 3]
    assert stored_values(spark, path) == [(1, "v3")]


def test_one_key_is_read_without_listing_the_store(spark, tmp_path):
    path = str(tmp_path / "store")
    store.put(numbers(spark, (1, "a"), (store.PERIOD_SECONDS + 1, "b")), path, 0)
    got = store.get(spark, path, "b", "k/1", 1)
    assert {f.split("/store/")[1].rsplit("/", 2)[0] for f in got.inputFiles()} == {"business=b/key_id=k%252F1/period=0"}  # escaped once more, as a URL
    # A folder that any listing of the whole store stumbles over.
    os.makedirs(tmp_path / "store" / "business=b" / "other=1" / "x=2")
    (tmp_path / "store" / "business=b" / "other=1" / "x=2" / "f.parquet").write_text("no table")
    with pytest.raises(Exception):
        store.read_store(spark, path).count()
    assert store.get(spark, path, "b", "k/1", 1).first()["value"] == "a"
    assert store.get(spark, path, "b", "k/1", store.PERIOD_SECONDS + 1).first()["value"] == "b"


def test_writers_that_share_a_store(spark, tmp_path):
    path = str(tmp_path / "store")
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda i: store.batch_number(spark, path, f"w{i}"), range(12)))
    assert sorted(taken) == list(range(12))
    assert [store.batch_number(spark, path, f"w{i}") for i in range(12)] == taken
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.put_one(spark, path, f"one{i}", "b", "k", i, f"v{i}"), range(6)))
    store.put_one(spark, path, "one3", "b", "k", 3, "v3")
    assert stored_values(spark, path) == [(i, f"v{i}") for i in range(6)]
    first = store.commit(numbers(spark, (7, "first")), path, "s:0")
    assert store.commit(numbers(spark, (7, "second")), path, "t:0") == first + 1
    store.commit(numbers(spark, (7, "first")), path, "s:0")
    assert (7, "second") in stored_values(spark, path)


def test_store_time_falls_back(spark):
    rows = values(spark, ["no time", result_json("2018-06-11 03:10:00")])
    got = rows.select(store.json_start_seconds("value", F.lit(7).cast("bigint")).alias("t"))
    assert as_rows(got, "t") == [(7,), (1528686600,)]
    assert store.keyed_rows(rows).where("timestamp IS NULL").count() == 1


def test_shared_dir_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base + "/x-") and first != second


def test_shared_dir_falls_back_to_the_warehouse():
    settings = {"spark.sql.warehouse.dir": "file:/w"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    assert shared_dir(session, "x").startswith("file:/w/x-")
    settings["spark.master"] = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session, "x")
    settings["spark.sql.warehouse.dir"] = "hdfs://nn/w"
    assert shared_dir(session, "x").startswith("hdfs://nn/w/x-")


def test_prepare_sets_the_runtime_settings(spark):
    other = prepare(spark.newSession())
    assert other.conf.get("spark.sql.session.timeZone") == "UTC"
    assert build_session() is not None
