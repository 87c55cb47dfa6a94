import random

import pytest
from pyspark.sql import functions as F

from helpers import as_rows
from tidegauge.functions.timeconv import div
from tidegauge.operators import counts, offsets, partition, running, windows


def one():
    return F.lit(1).cast("bigint")


def skewed(spark, n=600, seed=1):
    """Half of the rows share one key; some keys are NULL; ids have gaps."""
    rng = random.Random(seed)
    ids = sorted(rng.sample(range(n * 5), n))
    rows = [(rng.choice(["hot", "hot", "a", None]), i, rng.randrange(100)) for i in ids]
    return rows, spark.createDataFrame(rows, "key STRING, id BIGINT, x BIGINT").repartition(5)


@pytest.mark.parametrize("current", [True, False])
@pytest.mark.parametrize("block", [1, 7, 64, 10_000])
def test_running_matches_a_plain_scan(spark, block, current):
    rows, df = skewed(spark)
    blocks = [{"_far": div(F.col("id"), F.lit(block * 10))}, {"_near": div(F.col("id"), F.lit(block))}]
    measures = {"n": ("sum", one()), "top": ("max", F.col("x"))}
    got = running.running_by_key(df, ["key"], ["id"], blocks, measures, include_current=current)
    seen, expected = {}, []
    for key, i, x in rows:
        n, top = seen.get(key, (0, None))
        after = (n + 1, x if top is None else max(top, x))
        expected.append((i, key, *(after if current else (n, top))))
        seen[key] = after
    result = sorted((tuple(r) for r in got.select("id", "key", "n", "top").collect()), key=lambda r: r[0])
    assert result == expected


def test_hot_key_is_cut_into_blocks(spark):
    """No task has to scan more rows of a key than one block holds."""
    df = spark.range(5_000).select(F.lit("hot").alias("key"), F.col("id"))
    got = running.running_by_key(df, ["key"], ["id"], running.id_blocks("id", 100), {"n": ("sum", one())})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 + len(running.id_blocks("id", 100)) and "_id_100" in plan
    assert got.where("n <> id + 1").count() == 0


def test_sequential_ids(spark):
    df = spark.range(0, 1_000, 3).repartition(7)
    got = running.sequential_ids(df, ["id"], running.id_blocks("id", 50), start=10, name="no")
    assert as_rows(got, "id", "no") == [(i * 3, i + 10) for i in range(334)]


def test_running_reduce_and_count(spark):
    lines = spark.createDataFrame([(1, 50, "a,b,a"), (2, 40, "a,,c,")], "id BIGINT, in_time BIGINT, value STRING")
    words = running.csv_words(lines, ["id", "in_time"])
    got = running.running_reduce(words, ["id", "pos"], running.id_blocks("id", 1))
    assert as_rows(got, "id", "pos", "word", "in_time", "count") == [
        (1, 0, "a", 50, 1), (1, 1, "b", 50, 1), (1, 2, "a", 50, 2),
        (2, 0, "a", 50, 3), (2, 1, "", 40, 1), (2, 2, "c", 40, 1),
    ]
    got = running.running_count(words, ["id", "pos"], running.id_blocks("id", 1))
    assert ("a", 3) in as_rows(got, "word", "count")


def gappy_log(spark, seed=5):
    """Partition 0 holds two thirds of the rows; offsets have gaps and start above zero."""
    rng = random.Random(seed)
    rows = []
    for part, n in ((0, 400), (1, 150), (2, 1)):
        for off in sorted(rng.sample(range(20, 20 + 3 * n), n)):
            rows.append((part, off, off * 10, f"v{off}"))
    return rows, spark.createDataFrame(rows, "part BIGINT, off BIGINT, ms BIGINT, value STRING")


def expected_reads(rows, limit, start):
    result = []
    for part in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == part)
        earliest, latest = mine[0][1], mine[-1][1] + 1
        first = start(earliest, latest)
        if first < earliest or first > latest:
            first = latest
        result += [r for r in mine if r[1] >= first][:limit]
    return sorted(result)


@pytest.mark.parametrize("block", [1, 13, 1_000_000])
@pytest.mark.parametrize("limit", [1, 50, 10_000])
def test_bounded_reads_from_the_midpoint(spark, limit, block):
    rows, log = gappy_log(spark)
    got = offsets.read_from(log, limit, block=block)
    assert as_rows(got, *log.columns) == expected_reads(rows, limit, lambda a, b: a + (b - a) // 2)


@pytest.mark.parametrize("shift", [-1, 0, 5, 10_000])
def test_start_outside_the_log_reads_nothing(spark, shift):
    rows, log = gappy_log(spark)
    got = offsets.read_from(log, 30, start=F.col("earliest") + shift, block=10)
    assert as_rows(got, *log.columns) == expected_reads(rows, 30, lambda a, b: a + shift)


def test_building_a_read_runs_no_job(spark):
    _, log = gappy_log(spark)
    tracker, group = spark.sparkContext.statusTracker(), "lazy-read"
    spark.sparkContext.setJobGroup(group, group)
    offsets.read_from(log, 30, block=10)
    assert list(tracker.getJobIdsForGroup(group)) == []


def test_ids_over_the_whole_range(spark):
    ids = [k * (1 << 54) + k for k in range(200)] + [-(k + 1) * (1 << 55) for k in range(50)]
    rows = spark.createDataFrame([(i,) for i in ids], "id BIGINT")
    got = running.sequential_ids(rows, ["id"], running.id_blocks("id"), 0, name="no")
    assert as_rows(got, "id", "no") == [(i, n) for n, i in enumerate(sorted(ids))]


def test_offset_dump(spark):
    log = spark.createDataFrame([(0, 1, 99, "a,b")], "part INT, off BIGINT, ms BIGINT, value STRING")
    assert as_rows(offsets.dump_lines(log), "line") == [("99,a,b",)]


@pytest.mark.parametrize("block", [1, 9, 10_000])
def test_late_rows(spark, block):
    rng = random.Random(11)
    rows = [(i, i % 2, max(0, i * 900 - rng.choice([0, 0, 3_000, 9_000, 30_000]))) for i in range(300)]
    log = spark.createDataFrame(rows, "off BIGINT, part INT, ms BIGINT")
    got = windows.late_rows(log, "part", ["off"], running.id_blocks("off", block), 10_000)
    newest, expected = {}, []
    for off, part, ms in rows:
        mark = newest[part] - 3_500 if part in newest else None
        closes = ms // 10_000 * 10_000 + 9_999
        expected.append((off, mark, mark is not None and closes <= mark))
        newest[part] = max(newest.get(part, ms), ms)
    result = sorted((tuple(r) for r in got.select("off", "watermark", "late").collect()), key=lambda r: r[0])
    assert result == expected
    assert any(late for _, _, late in expected)


def test_measurements(spark):
    def lines(*texts):
        return spark.createDataFrame([(t,) for t in texts], "value STRING")

    stamped = lines("1526700293000,1526700294637,x", "1526700293001,1526700294999,y", "1,2", "bad")
    assert as_rows(counts.per_second_counts(stamped).where("key IS NOT NULL"), "key", "count") == [("1526700294", 2)]
    assert sum(n for (n,) in as_rows(counts.per_second_counts(stamped), "count")) == 4
    delay = counts.mean_delay_per_second(stamped).where("key IS NOT NULL")
    assert as_rows(delay, "key", "delay") == [("1526700294", (1637 + 1998) // 2)]
    assert as_rows(counts.bad_stamps(stamped), "value") == [("bad",)]

    measured = lines("a\t3", "a 4", "b\t5", "b", "c\tn/a", "d\t12.5", "")
    assert as_rows(counts.sum_by_key(measured), "key", "count") == [("a", 7), ("b", 5)]
    assert [tuple(r) for r in counts.tolerant_mean(measured).collect()] == [(3, 4, 2, 2)]
    empty = counts.tolerant_mean(lines("x")).collect()
    assert [tuple(r) for r in empty] == [(0, None, 0, 1)]


def test_word_count_and_record_lines(spark):
    texts = spark.createDataFrame([("the cow the",), ("",), (" moon\nthe ",)], "text STRING")
    assert as_rows(counts.word_count(texts), "word", "count") == [("cow", 1), ("moon", 1), ("the", 3)]
    record = spark.createDataFrame([("a 1\n\nb 2\n",)], "value STRING")
    assert as_rows(counts.record_lines(record), "value") == [("a 1",), ("b 2",)]


def test_placement(spark):
    rows = spark.range(64).select(F.col("id").cast("string").alias("value"), (F.col("id") % 5).cast("int").alias("partition"))
    placed = partition.place_by_number(rows, 5).withColumn("at", F.spark_partition_id())
    assert placed.where("at <> partition").count() == 0
    keyed = partition.place_by_key(rows, "partition", partitions=4).withColumn("at", F.spark_partition_id())
    assert keyed.select("partition", "at").distinct().count() == 5
    assert partition.place_evenly(rows, 8).rdd.getNumPartitions() == 8
    delays = spark.createDataFrame([(1, 2, "x", 1)], "in_time BIGINT, out_time BIGINT, value STRING, count INT")
    assert as_rows(partition.with_delay_partition(delays, 10), "partition") == [(sum(map(ord, "1,2,x,1")) % 10,)]
