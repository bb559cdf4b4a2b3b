"""Live anomaly flags with state (X4): each channel keeps its own running maximum.

``running_max_flags`` compares every row with ``factor`` times the largest earlier score of its
channel. The maximum lives in the stream's state store: it survives a restart through the
checkpoint, and is forgotten after a time without rows, by a timer behind the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .signals import event_time

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """State with timers needs the embedded store; set it where the session has another."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class RunningMax(StatefulProcessor):
    """Per channel: the largest score so far and the time of the newest row."""

    def __init__(self, factor: float, forget_ms: int):
        self.factor, self.forget_us = factor, 1000 * forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("running", "largest double, newest long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["at_us", "row_id"], kind="stable")
        known = self.state.get() if self.state.exists() else None
        largest, newest = known if known is not None else (None, None)
        thresholds, flags = [], []
        for at, score in zip(batch["at_us"], batch["score"], strict=True):
            if newest is not None and at - newest > self.forget_us:
                largest = None
            limit = None if largest is None else self.factor * largest
            thresholds.append(limit)
            flags.append(bool(limit is not None and score > limit))  # a missing score is no anomaly
            if score == score:
                largest = score if largest is None else max(largest, score)
            newest = int(at) if newest is None else max(newest, int(at))
        self.state.update((None if largest is None else float(largest), newest))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((newest + self.forget_us) // 1000 + 1)
        yield pd.DataFrame({"channel": key[0], "row_id": batch["row_id"], "score": batch["score"],
                            "threshold": pd.Series(thresholds, index=batch.index, dtype="float64"), "anomaly": flags})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        newest = self.state.get()[1] if self.state.exists() else None
        if newest is not None and newest + self.forget_us < 1000 * expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def running_max_flags(stream: DataFrame, ts: str, channel: str, score: str, row_id: str, factor: float = 1.05,
                      forget: str = "1 day", watermark: str = "10 minutes") -> DataFrame:
    """Flag rows above ``factor`` times the largest earlier score of their channel.

    Columns: channel, row_id, score, threshold (null for a channel's first row, and after a pause
    longer than ``forget``), anomaly. Rows of one micro-batch are taken by time, then id; rows
    later than the watermark are dropped. Missing scores are neither flagged nor remembered.
    """
    use_state_store(stream.sparkSession)
    ms = int(pd.Timedelta(forget).total_seconds() * 1000)
    rows = event_time(stream, ts).withWatermark("event_time", watermark)
    rows = rows.select(F.col(channel).cast("string").alias("channel"), F.col(row_id).cast("long").alias("row_id"),
                       F.col(score).cast("double").alias("score"), F.unix_micros("event_time").alias("at_us"), "event_time")
    return rows.groupBy("channel").transformWithStateInPandas(
        RunningMax(factor, ms), "channel string, row_id long, score double, threshold double, anomaly boolean",
        "Append", "EventTime")
