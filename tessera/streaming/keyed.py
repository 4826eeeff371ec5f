"""The incremental loop as keyed state: claims of periods, vintages of values.

State lives in the stream's store by key and moves on with its checkpoint, so
two feeds, a restart or a replayed batch see what was decided before. Rows of one
key are worked off in order of their time within a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STALE_MS = 6 * 3600 * 1000
_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def keyed_store(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in the store that keyed state needs."""
    before = spark.conf.get(_STORE[0], None)
    spark.conf.set(*_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE[0])
        else:
            spark.conf.set(_STORE[0], before)


def millis(time: Column) -> Column:
    return F.unix_millis(time.cast("timestamp"))


class Claims(StatefulProcessor):
    """One runner gets a period: its first asking claims it, and no other until it
    has ended, for good, or has run for longer than ``STALE_MS``; a timer then
    gives it back. Emits a row a claim."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "status string, at long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        status, at = self.held.get() if self.held.exists() else (None, 0)
        for r in sorted(rows, key=lambda r: (r.ms, r.what != "end", r.feed)):
            if r.what == "end":
                if status == "running":
                    status = "ended"
                    self.handle.deleteTimer(at + STALE_MS)
            elif status is None or status == "running" and r.ms - at > STALE_MS:
                status, at = "running", r.ms
                self.handle.registerTimer(at + STALE_MS)
                yield Row(job=key[0], period=key[1], ms=r.ms, feed=r.feed)
        if status is not None:
            self.held.update((status, at))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.held.exists():
            status, at = self.held.get()
            if status == "running" and at + STALE_MS <= expiredTimerInfo.getExpiryTimeInMs():
                self.held.clear()
        yield from ()

    def close(self) -> None:
        pass


def claims(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """(job, period, ms, feed) of every claim that askings and endings (job,
    period, now, what: ask or end, feed) lead to."""
    rows = stream.withColumn("at", F.col("now").cast("timestamp")).withWatermark("at", lateness).withColumn("ms", millis(F.col("at")))
    return rows.groupBy("job", "period").transformWithState(Claims(), "job string, period string, ms long, feed int", "append", "EventTime")


class Vintages(StatefulProcessor):
    """The last hash of a key's value and the number of its vintage; a row whose
    hash differs is a new vintage."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "h string, vintage int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        h, vintage = self.last.get() if self.last.exists() else (None, 0)
        for r in sorted(rows, key=lambda r: (r.ms, r.h is not None, r.h)):
            if vintage == 0 or r.h != h:
                h, vintage = r.h, vintage + 1
                yield Row(key=key[0], vintage=vintage, ms=r.ms, h=h)
        self.last.update((h, vintage))

    def close(self) -> None:
        pass


def vintages(stream: DataFrame, key: Column) -> DataFrame:
    """(key, vintage, ms, h) of every change of hash in stream (ms, h, ...)."""
    return stream.withColumn("_key", key).groupBy("_key").transformWithState(Vintages(), "key string, vintage int, ms long, h string", "append", "None")
