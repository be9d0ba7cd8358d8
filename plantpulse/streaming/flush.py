"""Points gathered until a batch is full or a deadline is over."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from plantpulse.sources.metrics import reading_lines

FULL, DUE = "full", "due"
OUTPUT = "shard INT, cause STRING, n INT, lines ARRAY<STRING>"


class PointBuffer(StatefulProcessor):
    """Pending lines of one shard in a list state, fewer than ``size`` of them between micro-batches.

    A batch of ``size`` lines is given out at once. The first line that has to wait sets a timer of processing time; when
    it goes off, what has gathered is given out. Giving out a batch starts the time anew.
    """

    def __init__(self, size: int, seconds: float):
        self.size, self.wait = size, int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._pending = handle.getListState("pending", "value STRING")
        self._due = handle.getValueState("due", "at BIGINT")

    def _stop_timer(self) -> None:
        due = self._due.get()
        if due is not None:
            self._handle.deleteTimer(due[0])
            self._due.clear()

    def _frame(self, key, cause: str, lines: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"shard": [key[0]], "cause": [cause], "n": [len(lines)], "lines": [lines]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pending = [r[0] for r in self._pending.get()]
        given = False
        for frame in rows:
            values = frame["value"].tolist()
            at = 0
            while len(pending) + len(values) - at >= self.size:
                take = self.size - len(pending)
                yield self._frame(key, FULL, pending + values[at:at + take])
                pending, at, given = [], at + take, True
            pending += values[at:]
        if given or not pending:
            self._stop_timer()
        if pending:
            self._pending.put([(v,) for v in pending])
            if not self._due.exists():
                at = timerValues.getCurrentProcessingTimeInMs() + self.wait
                self._handle.registerTimer(at)
                self._due.update((at,))
        else:
            self._pending.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        pending = [r[0] for r in self._pending.get()]
        self._pending.clear()
        self._due.clear()
        if pending:
            yield self._frame(key, DUE, pending)

    def close(self) -> None:
        pass


def gathered_points(clean: DataFrame, size: int = 50, seconds: float = 5.0, shards: int = 8) -> DataFrame:
    """Batches of line-protocol points of a clean stream with event time: shard, cause (full or due), n, lines.

    Points are dealt to ``shards`` by device and time, so a hot device fills the batches of all of them. Needs the RocksDB
    state store, and a trigger by processing time, as an ``availableNow`` run ends before its timers.
    """
    shard = F.pmod(F.xxhash64("device_id", "event_time"), F.lit(shards)).cast("int")
    points = reading_lines(clean.withColumn("shard", shard), keep=["shard"])
    return points.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=PointBuffer(size, seconds), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime")
