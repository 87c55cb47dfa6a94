"""Running aggregates per key that stay parallel when one key dominates.

A plain window per key sorts and scans all rows of a key in one task. Here the order is cut
into blocks; each block is scanned on its own and starts from what the blocks before it add
up to. Those block totals are summed before their exchange and are small, and they get their
own running aggregate the same way, one level coarser.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.text import as_column, split_fields
from tidegauge.functions.timeconv import div

Measures = dict[str, tuple[str, Column]]
_COMBINE = {"sum": F.sum, "max": F.max}

# Rows of one id block; with unique ids this bounds every group a single task has to scan.
BLOCK_ROWS = 1 << 20


def id_blocks(column: str, rows: int = BLOCK_ROWS, most: int | None = None) -> list[dict[str, Column]]:
    """Block levels for an order that starts with a numeric id, from coarse to fine.

    Each is 1,024 times as wide as the next. The coarsest cuts the ids up to ``most`` into about a
    thousand blocks; without it, the 64-bit ids into a few, so also with ids spread over that whole range no task
    gets more than their totals.
    """
    value, widths = F.col(column), [rows]
    while widths[-1] < (1 << 50 if most is None else most >> 10):
        widths.append(widths[-1] << 10)
    return [{f"_{column}_{width}": div(value, F.lit(width))} for width in reversed(widths)]


def sorted_blocks(column: str, rows_bits: int = 20) -> list[dict[str, Column]]:
    """Block levels for the numbers of ``numbered_in_order``: the number of a range of the sort is in their
    upper bits. Blocks are parts of a range, and a thousand ranges form a block of the coarser level."""
    value = F.col(column)
    return [{f"_{column}_far": F.shiftright(value, 43)}, {f"_{column}_near": F.shiftright(value, rows_bits)}]


def numbered_in_order(
    rows: DataFrame, order: list[str], path: str, expand: Callable[[DataFrame], DataFrame] | None = None, name: str = "at"
) -> DataFrame:
    """Rows written to ``path`` in ``order``, with a rising (not dense) number for ``id_blocks``.

    Where no column alone cuts the order into small blocks, as when one conversation holds a
    third of all words, a global sort does: its ranges are cut between any two rows. ``expand``
    may turn a row into several, which keep their order.
    """
    ordered = rows.orderBy(*order)
    numbered = (expand(ordered) if expand else ordered).withColumn(name, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    return rows.sparkSession.read.schema(numbered.schema).parquet(path)


def carried_on(totals: DataFrame, rows: DataFrame, key: str = "word") -> DataFrame:
    """Running values of ``running_reduce`` over new rows, raised by the ``totals`` of all rows before them."""
    before = totals.select(key, F.col("in_time").alias("_newest"), F.col("count").alias("_n"))
    joined = rows.join(before, key, "left")
    return joined.select(
        *[c for c in rows.columns if c not in ("in_time", "count")],
        F.greatest("in_time", "_newest").alias("in_time"), (F.col("count") + F.coalesce("_n", F.lit(0))).alias("count"),
    )


def running_by_key(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    blocks: list[dict[str, Column]],
    measures: Measures,
    include_current: bool = True,
) -> DataFrame:
    """Add running ``sum``/``max`` measures over ``order`` within ``keys``.

    ``blocks`` lists the block columns from coarse to fine. Together they must never fall
    as ``order`` rises. One exchange carries the rows; the others carry block totals only.
    A running sum that has seen no row is 0, a running max is NULL.
    """
    columns = rows.columns
    level_columns = [list(level) for level in blocks]
    inputs = {name: f"_in_{name}" for name in measures}
    prepared = rows.select(
        "*",
        *[value.alias(name) for level in blocks for name, value in level.items()],
        *[value.alias(inputs[name]) for name, (_, value) in measures.items()],
    )
    kinds = {name: kind for name, (kind, _) in measures.items()}
    result = _running(prepared, keys, order, level_columns, inputs, kinds, include_current)
    return result.select(*columns, *measures)


def _running(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    levels: list[list[str]],
    inputs: dict[str, str],
    kinds: dict[str, str],
    include_current: bool,
) -> DataFrame:
    last = 0 if include_current else -1
    if not levels:
        frame = Window.partitionBy(*keys).orderBy(*order)
        return rows.select(
            *rows.columns, *_measures(frame.rowsBetween(Window.unboundedPreceding, last), inputs, kinds)
        )

    group = [*keys, *[name for level in levels for name in level]]
    totals = rows.groupBy(*group).agg(
        *[_COMBINE[kinds[name]](column).alias(column) for name, column in inputs.items()]
    )
    before = _running(totals, keys, levels[-1], levels[:-1], inputs, kinds, False)
    # The state a block starts from goes in front of its rows, as one more row.
    seeds = before.select(
        *group, *[F.col(name).alias(inputs[name]) for name in inputs], F.lit(0).alias("_row")
    )
    seeded = rows.withColumn("_row", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    frame = Window.partitionBy(*group).orderBy("_row", *order)
    scanned = seeded.select(
        *seeded.columns,
        *_measures(frame.rowsBetween(Window.unboundedPreceding, last), inputs, kinds),
    )
    return scanned.where("_row = 1").drop("_row")


def _measures(window, inputs: dict[str, str], kinds: dict[str, str]) -> list[Column]:
    result = []
    for name, column in inputs.items():
        value = _COMBINE[kinds[name]](column).over(window)
        if kinds[name] == "sum":
            value = F.coalesce(value, F.lit(0).cast("bigint"))
        result.append(value.alias(name))
    return result


def running_reduce(
    words: DataFrame, order: list[str], blocks: list[dict[str, Column]], key: str = "word"
) -> DataFrame:
    """For every row the newest ``in_time`` and the number of rows of its word so far."""
    return running_by_key(
        words.withColumnRenamed("in_time", "_at"),
        [key],
        order,
        blocks,
        {"in_time": ("max", F.col("_at")), "count": ("sum", F.lit(1).cast("bigint"))},
    ).drop("_at")


def running_count(
    words: DataFrame, order: list[str], blocks: list[dict[str, Column]], key: str = "word"
) -> DataFrame:
    """For every row the number of rows of its word so far."""
    return running_by_key(
        words, [key], order, blocks, {"count": ("sum", F.lit(1).cast("bigint"))}
    )


def sequential_ids(
    rows: DataFrame, order: list[str], blocks: list[dict[str, Column]], start: int = 0, name: str = "id"
) -> DataFrame:
    """Dense ids in ``order``, counted up from ``start``."""
    numbered = running_by_key(
        rows, [], order, blocks, {name: ("sum", F.lit(1).cast("bigint"))}, include_current=False
    )
    return numbered.withColumn(name, F.col(name) + start)


def csv_words(lines: DataFrame, keep: list[str], value: str = "value") -> DataFrame:
    """Every comma-separated word with its position; the columns in ``keep`` are shared."""
    return lines.select(*keep, F.posexplode(split_fields(as_column(value), ",")).alias("pos", "word"))


def latest_totals(words: DataFrame, key: str = "word") -> DataFrame:
    """State of the running reduce: on a stream (update mode) one row per word and batch."""
    return words.groupBy(key).agg(
        F.max("in_time").alias("in_time"), F.count(F.lit(1)).alias("count")
    )
