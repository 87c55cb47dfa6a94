"""Running totals per word on a stream, with one result for every input row.

``operators.running.latest_totals`` in update mode gives one result per word and micro-batch
and combines rows before the exchange; use it where that is enough.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Ship this module with the query, so the workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "word STRING, in_time BIGINT, count BIGINT"


class RunningTotals(StatefulProcessor):
    """Keeps newest time and row count of a word; rows pass through in Arrow batches."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "in_time BIGINT, count BIGINT", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest, count = self.total.get() if self.total.exists() else (None, 0)
        for batch in rows:
            times = batch["in_time"].cummax()
            if newest is not None:
                times = times.clip(lower=newest)
            numbers = range(count + 1, count + len(batch) + 1)
            newest, count = int(times.iloc[-1]), count + len(batch)
            yield pd.DataFrame({"word": key[0], "in_time": times.to_numpy(), "count": numbers})
        self.total.update((newest, count))

    def close(self) -> None:
        pass


def running_totals(words: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """``(word, in_time, count)`` so far for every row of a ``(word, in_time)`` stream.

    A word's rows are numbered as they arrive. The rows of a word in one micro-batch pass
    through one task, so bound the micro-batches at the source. With ``ttl_ms`` a word is
    forgotten that long after its last row; such a stream never counts as used up, so start it
    with an interval.
    """
    return (
        words.select("word", "in_time")
        .groupBy("word")
        .transformWithStateInPandas(
            statefulProcessor=RunningTotals(ttl_ms),
            outputStructType=OUTPUT,
            outputMode="append",
            timeMode="ProcessingTime" if ttl_ms else "None",
        )
    )
