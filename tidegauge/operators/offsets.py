"""Read parts of a partitioned log kept as a table ``(part, off, ms, value)``.

Offsets are unique within a partition but may have gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.text import as_column
from tidegauge.functions.timeconv import div
from tidegauge.operators.running import BLOCK_ROWS


def offset_ranges(log: DataFrame) -> DataFrame:
    """Earliest offset, next offset after the newest, and their midpoint, per partition."""
    bounds = log.groupBy("part").agg(
        F.min("off").alias("earliest"), (F.max("off") + 1).alias("latest")
    )
    middle = F.col("earliest") + div(F.col("latest") - F.col("earliest"), F.lit(2))
    return bounds.withColumn("middle", middle)


def valid_start(start: Column | str, earliest: Column | str, latest: Column | str) -> Column:
    """A start outside the kept range becomes the latest offset."""
    start, earliest, latest = as_column(start), as_column(earliest), as_column(latest)
    return F.when((start < earliest) | (start > latest), latest).otherwise(start)


def plan_reads(
    log: DataFrame, max_reads: int, start: Column | None = None, block: int = BLOCK_ROWS
) -> DataFrame:
    """First and last offset to read, ``(part, first, last)``, at most one row per partition.

    Covers ``max_reads`` rows of a partition from its start offset. ``start`` may use
    ``earliest``, ``latest`` and ``middle``; the default is the midpoint. Rows are counted
    per block of offsets, so only the block in which the limit falls is ever sorted.
    """
    first = valid_start(F.col("middle") if start is None else start, "earliest", "latest")
    starts = offset_ranges(log).select("part", first.alias("first"))
    offsets = (
        log.select("part", "off")
        .where(F.col("off") >= starts.agg(F.min("first")).scalar())
        .join(starts, "part")
        .where(F.col("off") >= F.col("first"))
        .withColumn("_block", div(F.col("off"), F.lit(block)))
    )

    earlier = Window.partitionBy("part").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = offsets.groupBy("part", "first", "_block").agg(F.count(F.lit(1)).alias("_rows"))
    reached = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    final_block = (
        reached.where(F.col("_before") < max_reads)
        .groupBy("part", "first")
        .agg(F.max(F.struct("_block", "_before")).alias("_end"))
        .select(
            "part",
            F.col("_end._block").alias("_final"),
            (F.lit(max_reads) - F.col("_end._before")).alias("_left"),
        )
    )

    by_offset = Window.partitionBy("part").orderBy("off")
    tail = offsets.join(final_block, "part").where(F.col("_block") == F.col("_final"))
    return (
        tail.withColumn("_n", F.row_number().over(by_offset))
        .where(F.col("_n") <= F.col("_left"))
        .groupBy("part", "first")
        .agg(F.max("off").alias("last"))
    )


def read_from(
    log: DataFrame, max_reads: int, start: Column | None = None, block: int = BLOCK_ROWS
) -> DataFrame:
    """The rows of ``plan_reads``.

    The lowest and highest offset of all ranges are scalar subqueries, so the scan skips what
    lies outside of both and nothing runs before the result is asked for.
    """
    plan = plan_reads(log, max_reads, start, block)
    low, high = plan.agg(F.min("first")).scalar(), plan.agg(F.max("last")).scalar()
    return (
        log.where((F.col("off") >= low) & (F.col("off") <= high))
        .join(plan, "part")
        .where(F.col("off").between(F.col("first"), F.col("last")))
        .select(*log.columns)
    )


def dump_lines(log: DataFrame, ms: str = "ms", value: str = "value") -> DataFrame:
    """``timestamp,value`` text of every log row."""
    line = F.concat_ws(",", as_column(ms).cast("string"), value)
    return log.select("part", "off", line.alias("line"))
