"""Indicator maps that are due a fixed event time after their window.

The chained aggregation in ``jobs.stream_indicators`` emits a map when its window closes.
This form waits ten more minutes of event time, during which counts of the window can still
be replaced, and then forgets the window.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.classify import OTHER
from tidegauge.operators.windows import INDICATOR_DELAY_MS

# Ship this module with the query, so the workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "start_time BIGINT, end_time BIGINT, indexs MAP<STRING,BIGINT>"


class DueIndicators(StatefulProcessor):
    """Keeps ``type -> count`` of one window until its timer runs out, then emits it if the
    closing type came."""

    def __init__(self, size_ms: int, delay_ms: int, closing_type: str):
        self.size_ms = size_ms
        self.delay_ms = delay_ms
        self.closing_type = closing_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "counts MAP<STRING,BIGINT>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = dict(self.counts.get()[0]) if self.counts.exists() else {}
        for batch in rows:
            kept.update(zip(batch["type"], batch["count"].astype(int)))
        self.handle.registerTimer(int(key[0]) + self.size_ms - 1 + self.delay_ms)
        self.counts.update((kept,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = int(key[0])
        entries = sorted(self.counts.get()[0].items())
        self.counts.clear()
        if self.closing_type not in dict(entries):
            return
        yield pd.DataFrame(
            {
                "start_time": [start],
                "end_time": [start + self.size_ms - 1],
                "indexs": [dict(entries)],
            }
        )

    def close(self) -> None:
        pass


def due_indicators(
    counts: DataFrame,
    size_ms: int,
    delay_ms: int = INDICATOR_DELAY_MS,
    closing_type: str = OTHER,
) -> DataFrame:
    """Maps of windows that hold the closing type, ``delay_ms`` after the window's last ms.

    Input is the stream of ``window_counts``: a key gets one row per type, never raw rows.
    Needs the RocksDB state store, which ``session.prepare`` selects.
    """
    timed = counts.withColumn("ts", F.window_time("window"))
    return (
        timed.select("ts", "start_time", "type", "count")
        .groupBy("start_time")
        .transformWithStateInPandas(
            statefulProcessor=DueIndicators(size_ms, delay_ms, closing_type),
            outputStructType=OUTPUT,
            outputMode="append",
            timeMode="eventTime",
        )
    )
