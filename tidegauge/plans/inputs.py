"""Log shapes derived from the given tables.

Each function turns a whole table into the records one operator family reads. The oracle
builds the same records in SQL (``oracles.py``). A derived line is computed once, so that an
operator reads it like a stored column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.functions.text import words
from tidegauge.functions.timeconv import LOG_TIME, div
from tidegauge.operators.running import BLOCK_ROWS, id_blocks, numbered_in_order, running_by_key
from tidegauge.session import shared_dir
from tidegauge.sinks.folders import Folders
from tidegauge.sources.logs import table_stream


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_shared(events: DataFrame) -> DataFrame:
    """Columns the log shapes share: ``k``, event time ``ms`` and ``out_ms``."""
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        "event_id", "user_id", "event_type", "props", F.col("value").alias("amount"),
        ts.alias("at"), k.alias("k"), F.unix_millis(ts).alias("ms"),
    ).withColumn("out_ms", F.col("ms") + F.floor(F.col("amount") * 10).cast("bigint"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return with_shared(table(spark, folder, "events"))


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table read as a stream, whether it is one file or a folder of files.

    The stream source takes a single file only by a pattern, hence the braces.
    """
    schema = table(spark, folder, "events").schema
    return with_shared(table_stream(spark, f"{folder}/{{events}}.parquet", schema=schema))


def _by(value: Column, choices: dict[int, Column | str], otherwise: Column | str) -> Column:
    result = None
    for number, text in choices.items():
        result = (F if result is None else result).when(value == number, text)
    return result.otherwise(otherwise)


def interact_log(e: DataFrame) -> DataFrame:
    """``(event_id, user_id, value)``: interaction log lines."""
    user, k, kind = F.col("user_id"), F.col("k"), F.col("event_type")
    uid = F.when(user % 10 == 0, user).otherwise(2_000_000_000 + user * 12_347)
    code = (
        F.when(kind == "click", "14000003")
        .when(kind == "view", "14000005")
        .when(kind == "error", "14000098")
        .otherwise("14000116")
    )
    mode = F.when((kind == "signup") & (k % 4 == 3), "0").otherwise("1")
    pages = _by(
        k % 4,
        {
            0: "luicode:10000408;uicode:10000001",
            1: "uicode:10000002;luicode:10000002",
            2: "luicode:10000001;uicode:10000408",
        },
        "uicode:10000408",
    )
    insert = _by(
        k % 5,
        {4: ";ext:none", 3: ";ext:insert_type:1|oriuicode:10000001"},
        ";ext:insert_type:5|oriuicode:10000001",
    )
    extend = F.concat(
        F.lit("object=>"), F.col("event_id"), F.lit(",from=>page:77;x:1_2;"),
        pages, insert,
    )
    address = F.concat(F.lit("10.0."), user % 256, F.lit("."), k)
    line = F.concat_ws(
        "\t", F.date_format("at", LOG_TIME), address, uid, code, F.lit("100200"), mode,
        F.lit("1"), F.col("event_id"), user, extend,
    )
    return compute_once(e, "value", line).select("event_id", "user_id", "value")


def word_lines(e: DataFrame) -> DataFrame:
    """``(event_id, in_time, value)``: ``time,word,...`` with empty fields inside and at the end."""
    k = F.col("k")
    third = F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("k"), k % 10))
    fourth = F.when(k % 11 == 0, "").otherwise(F.col("event_type"))
    user = F.concat(F.lit("u"), F.col("user_id") % 7)
    line = F.concat_ws(",", "ms", "event_type", user, third, fourth)
    return compute_once(e, "value", line).select("event_id", F.col("ms").alias("in_time"), "value")


def json_log(e: DataFrame) -> DataFrame:
    """``(event_id, in_time, out_time, value)``: JSON records, some broken."""
    user, k = F.col("user_id"), F.col("k")

    def download(target: str) -> Column:
        head = f'{{"service_id":"downloader","idc":"{target}","pid":"p'
        return F.concat(F.lit(head), user, F.lit('"}'))

    value = _by(
        k % 6,
        {
            0: download("al"),
            1: download("gz"),
            2: F.concat(F.lit('{"idc":"","pid":"p'), k, F.lit('"}')),
            3: F.concat(F.lit('{"pid":"p'), k, F.lit('"}')),
            4: F.concat(F.lit("broken "), F.col("event_type")),
        },
        '{"idc":null}',
    )
    return compute_once(e, "value", value).select(
        "event_id", F.col("ms").alias("in_time"), F.col("out_ms").alias("out_time"), "value"
    )


def stamp_log(e: DataFrame) -> DataFrame:
    """``(event_id, tm_num, ts_num, value)``: ``in,out,value,count`` lines of a test grid."""
    tm = F.when(F.col("user_id") % 2 == 0, 1).otherwise(4)
    ts = _by(F.col("k") % 3, {0: F.lit(1), 1: F.lit(4)}, F.lit(16))
    line = F.concat_ws(",", "ms", "out_ms", "event_type", F.lit("1"))
    return compute_once(e, "value", line).select(
        "event_id", tm.alias("tm_num"), ts.alias("ts_num"), "value"
    )


def measure_lines(e: DataFrame) -> DataFrame:
    """``(event_id, value)``: ``key<TAB>number`` lines, some short or with a bad number."""
    key = F.substring(F.col("ms").cast("string"), 1, 10)
    value = _by(
        F.col("k") % 10,
        {0: key, 1: F.concat(key, F.lit("\tn/a")), 2: F.concat(key, F.lit("\t12.5"))},
        F.concat(key, F.lit("\t"), F.floor(F.col("amount") * 10).cast("bigint")),
    )
    return compute_once(e, "value", value).select("event_id", "value")


def offset_log(e: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """``(part, off, ms, value)``: the events as a log of four partitions."""
    rows = e.select(
        "event_id", (F.col("user_id") % 4).alias("part"), "ms", F.col("props").alias("value")
    )
    one = F.lit(1).cast("bigint")
    numbered = running_by_key(
        rows, ["part"], ["event_id"], id_blocks("event_id", block), {"off": ("sum", one)},
        include_current=False,
    )
    return numbered.select("part", "off", "ms", "value")


def offset_table(spark: SparkSession, folder: str) -> DataFrame:
    """``offset_log`` written to the shared folder, as a log that is read in several passes."""
    path = shared_dir(spark, "log")
    offset_log(events(spark, folder)).write.parquet(path)
    return spark.read.schema("part BIGINT, off BIGINT, ms BIGINT, value STRING").parquet(path)


def arrival_log(e: DataFrame) -> DataFrame:
    """``(event_id, part, arrival, ms)``: rows that reach their log partition late by ``k``."""
    return e.select(
        "event_id", (F.col("user_id") % 4).alias("part"),
        (F.col("ms") + F.col("k") * 6000).alias("arrival"), "ms",
    )


def spoken_words(spark: SparkSession, folder: str) -> DataFrame:
    """``(conv_id, turn, pos, word, at)``: every word of the conversations, numbered in order."""
    def expand(turns: DataFrame) -> DataFrame:
        return turns.select("conv_id", "turn", F.posexplode(words("text")).alias("pos", "word"))

    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return numbered_in_order(turns, ["conv_id", "turn"], shared_dir(spark, "spoken"), expand)


def late_words(e: DataFrame) -> DataFrame:
    """``(event_id, arrival, value)``: word lines that arrive up to days after their time."""
    lines = word_lines(e).select("event_id", "value")
    return lines.join(e.select("event_id", (F.col("ms") + F.col("k") * 3_600_000).alias("arrival")), "event_id")


def late_events(e: DataFrame) -> DataFrame:
    """``(event_id, arrival, ms)``: rows that arrive up to days after their time."""
    return e.select("event_id", (F.col("ms") + F.col("k") * 3_600_000).alias("arrival"), "ms")


# Streams that need several micro-batches get a table in so many slices, one after the other.
SLICES = 4


def with_slice(rows: DataFrame, by: str) -> DataFrame:
    """Add ``slice``, 0 to SLICES - 1: equal widths of the whole number ``by``."""
    low, high = rows.agg(F.min(by), F.max(by)).first()
    width = 1 if low is None else high - low + 1
    return rows.withColumn("slice", div((F.col(by) - F.lit(low)) * SLICES, F.lit(width)))


def add_slice(sliced: DataFrame, number: int, path: str) -> None:
    """Append one slice to the files of ``path``."""
    sliced.where(F.col("slice") == number).drop("slice").write.mode("append").parquet(path)


def add_slice_whole(sliced: DataFrame, number: int, path: str, column: str, values: list[int]) -> None:
    """Add one slice to ``<path>/in/<column>=<value>`` while a stream reads it: each folder at once."""
    fresh = f"new{number}"
    sliced.where(F.col("slice") == number).drop("slice").write.partitionBy(column).parquet(f"{path}/{fresh}")
    folders = Folders(sliced.sparkSession, path)
    for name in (f"{column}={value}" for value in values):
        if folders.exists(f"{fresh}/{name}"):
            folders.move(f"{fresh}/{name}", f"in/{name}/slice={number}")


def loose_times(e: DataFrame) -> DataFrame:
    """``(event_id, value)``: log times with parts out of range, of odd width, or missing."""
    k, user = F.col("k"), F.col("user_id")
    padded = F.date_format("at", LOG_TIME)
    odd = F.concat(
        F.year("at"), F.lit("-"), k % 30, F.lit("-"), user % 90, F.lit(" "), k, F.lit(":"), user % 150, F.lit(":"), k * 7, F.lit(" rest"),
    )
    value = _by(
        k % 5, {0: padded, 1: F.concat(padded, F.lit("\tmore")), 2: F.substring(padded, 1, 13), 3: F.concat(F.lit("x"), padded)}, odd
    )
    return compute_once(e, "value", value).select("event_id", "value")
