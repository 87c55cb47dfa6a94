"""Registered queries: ``name -> (spark, folder) -> DataFrame`` over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.codec import (
    DELAY_FIELDS,
    count_json,
    csv_bytes,
    csv_line,
    indicator_json,
    key_value_line,
    parse_delay,
)
from tidegauge.functions.hashing import char_sum, json_text
from tidegauge.functions.text import reverse_words
from tidegauge.functions.timeconv import block_floor, div, ms_to_seconds, parse_ms_lenient, window_floor
from tidegauge.operators import classify as cl
from tidegauge.operators import counts, offsets, partition, route, running, stamp, windows
from tidegauge.plans import inputs
from tidegauge.session import prepare, shared_dir
from tidegauge.sinks import files, store
from tidegauge.sources import logs

WINDOW_MS = 600_000
SHORT_WINDOW_MS = 10_000
DIGIT = 5
PARTITIONS = 16
MAX_READS = 1_000
FIRST_ID = 1_000
PURCHASE = "purchase"

REGISTRY = {}


def query(function):
    """Register a query under the name of its function."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder)

    REGISTRY[function.__name__] = run
    return run


def _type_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.interact_log(inputs.events(spark, folder))
    return windows.window_counts(cl.interaction_events(lines, DIGIT), WINDOW_MS)


def _indicators(spark: SparkSession, folder: str) -> DataFrame:
    return windows.window_indicators(_type_counts(spark, folder), WINDOW_MS)


# -- interactions -------------------------------------------------------------------------


@query
def classify_interactions(spark, folder):
    lines = inputs.interact_log(inputs.events(spark, folder))
    return cl.classify(lines, DIGIT).select("event_id", "ms", "type")


@query
def classify_fixed_digit(spark, folder):
    lines = inputs.interact_log(inputs.events(spark, folder))
    return cl.classify(lines, 3, fixed=True).select("event_id", "ms", "type")


@query
def bad_record_counts(spark, folder):
    e = inputs.events(spark, folder)
    mixed = inputs.interact_log(e).select("value").unionByName(inputs.word_lines(e).select("value"))
    bad = F.col("type") == cl.BAD_RECORD
    return cl.classify(mixed, DIGIT).agg(
        F.count_if(~bad).alias("usable"), F.count_if(bad).alias("bad")
    )


@query
def window_type_counts(spark, folder):
    return _type_counts(spark, folder).drop("window")


@query
def window_type_counts_json(spark, folder):
    text = count_json("start_time", "end_time", "type", "count")
    return _type_counts(spark, folder).select(text.alias("value"))


@query
def window_type_counts_csv(spark, folder):
    text = csv_line("start_time", "end_time", "type", "count")
    return _type_counts(spark, folder).select(text.alias("value"))


@query
def window_indicator_map(spark, folder):
    text = indicator_json("start_time", "end_time", "indexs")
    return _indicators(spark, folder).select("start_time", text.alias("value"))


@query
def indicator_map_merge(spark, folder):
    """Maps of even and odd users per window, merged; the odd side wins."""
    lines = inputs.interact_log(inputs.events(spark, folder))
    parsed = cl.classify(lines, DIGIT).where(F.col("type") != cl.BAD_RECORD)
    sided = parsed.groupBy(
        window_floor("ms", WINDOW_MS).alias("start_time"), "type", (F.col("user_id") % 2).alias("side")
    ).agg(F.count(F.lit(1)).alias("count"))

    def side_map(number):
        pair = F.when(F.col("side") == number, F.struct("type", "count"))
        return F.map_from_entries(F.array_sort(F.collect_list(pair)))

    sides = sided.groupBy("start_time").agg(side_map(0).alias("left"), side_map(1).alias("right"))
    merged = windows.merge_indicators("left", "right")
    end = F.col("start_time") + (WINDOW_MS - 1)
    return sides.select("start_time", indicator_json("start_time", end, merged).alias("value"))


# -- words in windows ---------------------------------------------------------------------


def _word_windows(spark, folder, size_ms):
    lines = inputs.word_lines(inputs.events(spark, folder))
    return windows.word_window_bounds(windows.word_events(lines), size_ms)


@query
def word_window_bounds(spark, folder):
    return _word_windows(spark, folder, SHORT_WINDOW_MS)


@query
def word_window_bounds_600s(spark, folder):
    return _word_windows(spark, folder, WINDOW_MS)


@query
def late_data_audit(spark, folder):
    log = inputs.arrival_log(inputs.events(spark, folder))
    # What one source sends in a second is bounded by its rate, so a second can be scanned whole.
    blocks = [
        {"_day": div(F.col("arrival"), F.lit(86_400_000))},
        {"_second": div(F.col("arrival"), F.lit(1_000))},
    ]
    return windows.late_rows(log, "part", ["arrival", "event_id"], blocks, WINDOW_MS)


@query
def indicator_partial_maps(spark, folder):
    """Maps of every log partition merged; of a type that several have, the last partition counts."""
    lines = inputs.interact_log(inputs.events(spark, folder)).withColumn("part", F.col("user_id") % 4)
    typed = cl.classify(lines, DIGIT).where("ms IS NOT NULL")
    start = window_floor("ms", WINDOW_MS).alias("start_time")
    found = typed.groupBy("part", start, "type").agg(F.count(F.lit(1)).alias("count"))
    maps = found.groupBy("part", "start_time").agg(F.map_from_entries(F.collect_list(F.struct("type", "count"))).alias("indexs"))
    merged = windows.merge_partial_maps(maps, ["start_time"], ["part"])
    text = indicator_json("start_time", F.col("start_time") + WINDOW_MS - 1, "indexs")
    return merged.select("start_time", text.alias("value"))


# -- words --------------------------------------------------------------------------------


@query
def batch_word_count(spark, folder):
    return counts.word_count(inputs.table(spark, folder, "documents"))


@query
def record_line_count(spark, folder):
    texts = inputs.table(spark, folder, "documents").select(F.col("text").alias("value"))
    return counts.record_lines(texts).groupBy("value").agg(F.count(F.lit(1)).alias("count"))


@query
def storm_word_running(spark, folder):
    words = inputs.spoken_words(spark, folder)
    return running.running_count(words, ["at"], running.sorted_blocks("at")).drop("at")


@query
def running_reduce(spark, folder):
    lines = inputs.word_lines(inputs.events(spark, folder))
    words = running.csv_words(lines, ["event_id", "in_time"])
    return running.running_reduce(words, ["event_id", "pos"], running.id_blocks("event_id"))


@query
def reverse_word_order(spark, folder):
    return inputs.table(spark, folder, "documents").select(
        "doc_id", reverse_words("text").alias("reversed")
    )


# -- routing and stamps -------------------------------------------------------------------


@query
def route_json(spark, folder):
    records = inputs.json_log(inputs.events(spark, folder))
    return route.with_route(records).select("event_id", "route")


@query
def route_counts(spark, folder):
    return route.route_counts(route.with_route(inputs.json_log(inputs.events(spark, folder))))


@query
def route_folders(spark, folder):
    routed = route.with_route(inputs.json_log(inputs.events(spark, folder)))
    path = F.concat_ws("/", F.lit(files.versioned_base("out", "1")), files.route_folder())
    return route.route_counts(routed).select(path.alias("path"), "n")


@query
def select_route_al(spark, folder):
    routed = route.with_route(inputs.json_log(inputs.events(spark, folder)))
    line = csv_line("in_time", "out_time", "value")
    return route.select_route(routed, "al").select("event_id", line.alias("line"))


@query
def tag_lines(spark, folder):
    records = inputs.json_log(inputs.events(spark, folder))
    return stamp.tag_lines(records, 4, 16, F.col("in_time")).select("event_id", "value")


@query
def stamp_lines(spark, folder):
    records = inputs.json_log(inputs.events(spark, folder)).select(
        "event_id", "value", F.col("in_time").alias("_in"), F.col("out_time").alias("_out")
    )
    stamped = stamp.stamp_departure(stamp.stamp_arrival(records, F.col("_in")), F.col("_out"))
    return stamped.select("event_id", csv_line("in_time", "out_time", "value").alias("line"))


@query
def stamp_both(spark, folder):
    records = inputs.json_log(inputs.events(spark, folder))
    return stamp.stamp_both(records, F.col("in_time")).select(
        files.record_json(*DELAY_FIELDS).alias("value")
    )


@query
def copy_lines(spark, folder):
    e = inputs.events(spark, folder)
    sparse = e.select(F.when(F.col("k") % 7 != 0, F.col("props")).alias("value"))
    return stamp.copy_lines(sparse)


@query
def bucket_path(spark, folder):
    records = inputs.stamp_log(inputs.events(spark, folder))
    tagged = stamp.tag_lines(records, F.col("tm_num"), F.col("ts_num"), F.lit(0))
    return tagged.select("event_id", files.bucket_path("out").alias("path"))


@query
def bucketed_files(spark, folder):
    """Lines written to one folder per grid cell and read back."""
    records = inputs.stamp_log(inputs.events(spark, folder))
    tagged = stamp.tag_lines(records, F.col("tm_num"), F.col("ts_num"), F.lit(0)).select("value")
    path = shared_dir(spark, "buckets")
    files.write_bucketed(
        tagged.select("value", *[c.alias(n) for n, c in files.bucket_fields().items()]),
        path, "tm_num", "ts_num",
    )
    back = spark.read.schema("value STRING, tm_num INT, ts_num INT").parquet(path)
    return back.groupBy("tm_num", "ts_num").agg(F.count("value").alias("n"))


@query
def lenient_times(spark, folder):
    times = inputs.loose_times(inputs.events(spark, folder))
    return times.select("event_id", parse_ms_lenient("value").alias("ms"))


@query
def keyed_text_files(spark, folder):
    """Word counts written as sorted ``key<TAB>value`` files and read back as lines."""
    path = shared_dir(spark, "keyed")
    events = inputs.word_lines(inputs.events(spark, folder))
    found = running.csv_words(events, []).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    files.write_keyed_text(found.where("word <> ''"), path, "word", "count")
    return counts.sum_by_key(logs.text_lines(spark, path))


# -- measurements -------------------------------------------------------------------------


def _config_seconds(spark, folder):
    """``key<TAB>count`` lines per grid cell, as the per-second job writes them."""
    records = inputs.stamp_log(inputs.events(spark, folder))
    per_second = counts.per_second_counts(records, "tm_num", "ts_num")
    return per_second.select("tm_num", "ts_num", key_value_line("key", "count").alias("value"))


@query
def throughput_per_second(spark, folder):
    return counts.per_second_counts(inputs.stamp_log(inputs.events(spark, folder)))


@query
def throughput_rollup(spark, folder):
    return counts.sum_by_key(_config_seconds(spark, folder))


@query
def set_aside_measures(spark, folder):
    lines = inputs.measure_lines(inputs.events(spark, folder))
    return counts.set_aside(lines).groupBy("value").agg(F.count(F.lit(1)).alias("count"))


@query
def throughput_grid(spark, folder):
    return counts.mean_by_config(_config_seconds(spark, folder))


@query
def delay_per_second(spark, folder):
    return counts.mean_delay_per_second(inputs.stamp_log(inputs.events(spark, folder)))


@query
def delay_summary_tolerant(spark, folder):
    return counts.tolerant_mean(inputs.measure_lines(inputs.events(spark, folder)))


@query
def csv_codec_roundtrip(spark, folder):
    parsed = inputs.stamp_log(inputs.events(spark, folder)).select(
        "event_id", parse_delay("value").alias("_e")
    )
    fields = parsed.select("event_id", "_e.*")
    return fields.select(
        "event_id", *DELAY_FIELDS, csv_line(*DELAY_FIELDS).alias("line"),
        F.octet_length(csv_bytes(*DELAY_FIELDS)).cast("bigint").alias("bytes"),
    )


# -- partitions, offsets, ids -------------------------------------------------------------


@query
def char_sum_partition(spark, folder):
    texts = inputs.table(spark, folder, "documents")
    return partition.with_text_partition(texts, PARTITIONS, "text").select("doc_id", "partition")


@query
def char_sum_hash(spark, folder):
    texts = inputs.table(spark, folder, "documents")
    return texts.select("doc_id", char_sum("text").alias("char_sum"))


@query
def delay_event_partition(spark, folder):
    parsed = inputs.stamp_log(inputs.events(spark, folder)).select(
        "event_id", parse_delay("value").alias("_e")
    )
    placed = partition.with_delay_partition(parsed.select("event_id", "_e.*"), PARTITIONS)
    return placed.select("event_id", "partition")


@query
def pid_partition(spark, folder):
    records = inputs.json_log(inputs.events(spark, folder))
    placed = partition.with_field_partition(records, "pid", PARTITIONS, "event_id")
    return placed.select("event_id", json_text("value", "pid").isNull().alias("is_fallback"), "partition")


@query
def placed_partitions(spark, folder):
    """Rows per partition after the exchange by partition number."""
    records = inputs.json_log(inputs.events(spark, folder))
    numbered = partition.with_field_partition(records, "pid", PARTITIONS, "event_id")
    placed = partition.place_by_number(numbered, PARTITIONS)
    return placed.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("event_id").alias("n"))


@query
def offset_bounds(spark, folder):
    return offsets.offset_ranges(inputs.offset_log(inputs.events(spark, folder)))


@query
def offset_range_scan(spark, folder):
    return offsets.read_from(inputs.offset_table(spark, folder), MAX_READS)


@query
def offset_out_of_range(spark, folder):
    """Start positions asked for, and where reading starts."""
    ranges = offsets.offset_ranges(inputs.offset_log(inputs.events(spark, folder)))
    asked = ranges.select(
        "*", F.explode(F.array(F.col("earliest") - 1, "middle", "latest", F.col("latest") + 1)).alias("asked")
    )
    return asked.select("part", "asked", offsets.valid_start("asked", "earliest", "latest").alias("start"))


@query
def offset_log_dump(spark, folder):
    return offsets.dump_lines(inputs.offset_log(inputs.events(spark, folder)))


@query
def sequential_ids(spark, folder):
    rows = inputs.table(spark, folder, "events").select("event_id")
    return running.sequential_ids(rows, ["event_id"], running.id_blocks("event_id"), FIRST_ID)


@query
def block_floor_window(spark, folder):
    seconds = ms_to_seconds("ms")
    return inputs.events(spark, folder).select(
        "event_id", seconds.alias("second"), block_floor(seconds).alias("slot")
    )


# -- keyed store --------------------------------------------------------------------------


@query
def store_lookup(spark, folder):
    """Indicator maps written to the store, then looked up for every window with a purchase."""
    text = indicator_json("start_time", "end_time", "indexs")
    path = shared_dir(spark, "store")
    store.put(store.keyed_rows(_indicators(spark, folder).select(text.alias("value"))), path, 0)
    bought = inputs.events(spark, folder).where(F.col("event_type") == PURCHASE)
    wanted = bought.select(
        F.lit(store.INDICATOR_BUSINESS).alias("business"),
        F.lit(store.INDICATOR_KEY).alias("key_id"),
        ms_to_seconds(window_floor("ms", WINDOW_MS)).alias("timestamp"),
    ).distinct()
    return store.get_many(store.read_store(spark, path), wanted)


@query
def store_one_key(spark, folder):
    """The newest window's map, looked up alone in a store of three batches."""
    path = shared_dir(spark, "store")
    rows = _stored_maps(spark, folder)
    for batch in range(3):
        store.put(rows.where(F.col("n") % 3 >= batch).drop("n"), path, batch)
    newest = rows.agg(F.max("timestamp")).first()[0]
    return store.get(spark, path, store.INDICATOR_BUSINESS, store.INDICATOR_KEY, newest or 0)


@query
def store_compacted(spark, folder):
    """Two writers, one of which repeats its last batch, between and after compactions."""
    path = shared_dir(spark, "store")
    rows = _stored_maps(spark, folder)

    def write(token, part, mark):
        value = F.concat(F.lit(mark), "value").alias("value")
        store.commit(part.select("business", "key_id", "timestamp", value), path, token)

    def compact():
        for period in store.periods(spark, path, store.INDICATOR_BUSINESS, store.INDICATOR_KEY):
            store.compact(spark, path, store.INDICATOR_BUSINESS, store.INDICATOR_KEY, period)

    write("a:0", rows, "a0")
    write("b:0", rows.where("n % 2 = 0"), "b0")
    compact()
    write("a:1", rows.where("n % 3 = 0"), "a1")
    write("b:1", rows.where("n % 5 = 0"), "b1")
    compact()
    write("b:1", rows.where("n % 5 = 0"), "b1")
    return store.current(store.read_store(spark, path))


def _stored_maps(spark, folder):
    """Indicator maps as store rows, with the number ``n`` of their window; written once."""
    path = shared_dir(spark, "maps")
    text = indicator_json("start_time", "end_time", "indexs")
    rows = store.keyed_rows(_indicators(spark, folder).select(text.alias("value")))
    rows.withColumn("n", div(F.col("timestamp"), F.lit(WINDOW_MS // 1000))).write.parquet(path)
    return spark.read.parquet(path)
