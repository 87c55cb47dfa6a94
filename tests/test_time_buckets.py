"""Time buckets on a stream: complete ones are marked, late rows set aside, repeats change nothing."""

import os
import shutil

import pytest

from helpers import as_rows
from tidegauge.sources.logs import table_stream
from tidegauge.streaming import jobs

HOUR = 3_600_000
SCHEMA = "id BIGINT, ms BIGINT"


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, root):
    stream = table_stream(spark, f"{root}/in", schema=spark.createDataFrame([], SCHEMA).schema)
    jobs.bucket_files(stream, HOUR, f"{root}/out", f"{root}/cp").awaitTermination()
    return as_rows(jobs.closed_buckets(spark, f"{root}/out", SCHEMA), "id", "bucket")


def late(spark, root):
    return as_rows(spark.read.schema("id BIGINT").option("recursiveFileLookup", "true").parquet(f"{root}/out/late"), "id")


BATCHES = [
    [(1, 10), (2, HOUR - 1), (3, HOUR + 3_499), (4, None)],
    [(5, 20), (6, HOUR + 3_500)],
    [(7, 30), (8, HOUR), (9, 3 * HOUR)],
    [(10, 2 * HOUR - 1), (11, 2 * HOUR)],
]
FIRST, SECOND = "1970-01-01--00", "1970-01-01--01"
# Up to the millisecond: the first hour closes when a time of HOUR + 3500 has been seen.
CLOSED = [[], [(1, FIRST), (2, FIRST), (5, FIRST)], None, None]


def test_buckets_close_with_the_watermark(spark, tmp_path):
    root = str(tmp_path)
    seen = []
    for rows in BATCHES:
        add(spark, f"{root}/in", rows)
        seen.append(run(spark, root))
    assert seen[:2] == CLOSED[:2]
    hours = [*CLOSED[1], (3, SECOND), (6, SECOND), (8, SECOND)]
    assert seen[2] == sorted(hours) == seen[3]
    assert late(spark, root) == [(4,), (7,), (10,)]
    assert sorted(os.listdir(f"{root}/out/state")) == ["batch=2", "batch=3"]
    # An open bucket's folder is there and isn't read.
    assert any("--02" in name for name in os.listdir(f"{root}/out/rows"))


@pytest.mark.parametrize("stage", ["before", "rows", "all"])
def test_a_repeated_batch_changes_nothing(spark, tmp_path, stage, monkeypatch):
    root = str(tmp_path)
    for number, rows in enumerate(BATCHES):
        add(spark, f"{root}/in", rows)
        if stage != "all":
            # A stop within the batch: before its marks, or before its state is written.
            def fail(*_):
                raise RuntimeError("stopped")

            with monkeypatch.context() as patch:
                patch.setattr(jobs.Folders, "mark" if stage == "rows" else "drop", fail)
                try:
                    run(spark, root)
                except Exception as error:
                    assert "stopped" in str(error)
        got = run(spark, root)
        if stage == "all":
            # The batch was done, but its commit is lost.
            for name in (f"{number}", f".{number}.crc"):
                path = f"{root}/cp/commits/{name}"
                if os.path.exists(path):
                    shutil.move(path, f"{root}/lost{name}")
            got = run(spark, root)
    assert got == [(1, FIRST), (2, FIRST), (3, SECOND), (5, FIRST), (6, SECOND), (8, SECOND)]
    assert late(spark, root) == [(4,), (7,), (10,)]


def test_no_complete_bucket(spark, tmp_path):
    root = str(tmp_path)
    add(spark, f"{root}/in", [(1, 5)])
    assert run(spark, root) == []
    assert jobs.closed_buckets(spark, f"{root}/nothing", SCHEMA).columns == ["id", "ms", "bucket"]
