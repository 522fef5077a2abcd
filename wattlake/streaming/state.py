"""Stateful processors: the hour trigger (T4, T5) and staleness timers.

State lives in the query's own checkpoint. A batch that fails is repeated from
the state before it, so what it had decided is decided again and nothing else.
The processors need the RocksDB state store; ``rocksdb`` sets it for the start of
one query and leaves the session as it was.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wattlake.functions.timecols import epoch_seconds

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class _Hours(StatefulProcessor):
    """Fires the batch's hours that are later than the last fired one; the state is that hour."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "hour long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        # rows of a batch come in any order; hours of a batch are few
        fired = sorted({r.hour for r in rows if last is None or r.hour > last})
        if fired:
            self.last.update((fired[-1],))
        for hour in fired:
            yield Row(feed=key[0], hour=hour)

    def close(self) -> None:
        pass


def fired_hours(stream: DataFrame, feed: str = "demand") -> DataFrame:
    """T4: ``(feed, hour)`` of every hour that starts with a minute-0 event and is later than all fired before.

    Only minute-0 events reach the state, one row an hour and input partition, so
    one feed is little work however many events it has. A late hour never fires.
    """
    hour = F.floor(epoch_seconds("time") / 3600).cast("bigint")
    first = stream.where(F.minute("time") == 0).select(F.lit(feed).alias("feed"), hour.alias("hour"))
    fired = first.groupBy("feed").transformWithState(_Hours(), "feed string, hour long", "append", "none")
    return fired.select("feed", F.expr("timestamp_ntz '1970-01-01' + make_dt_interval(0, hour)").alias("hour"))


class _Silence(StatefulProcessor):
    """Remembers a region's newest event and reports its age whenever its timer expires."""

    def __init__(self, every: int):
        self.every = every * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "micros long, since long")

    def _wait(self, timerValues) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.last.update((None, timerValues.getCurrentProcessingTimeInMs()))
        self._wait(timerValues)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = max((r.micros for r in rows if r.micros is not None), default=None)
        held, since = self.last.get() if self.last.exists() else (None, timerValues.getCurrentProcessingTimeInMs())
        if newest is not None and (held is None or newest > held):
            held = newest
        self.last.update((held, since))
        if not list(self.handle.listTimers()):
            self._wait(timerValues)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        micros, since = self.last.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        # a region that has sent nothing is as old as the query's knowledge of it
        age = now - (since if micros is None else micros // 1000)
        self.handle.registerTimer(now + self.every)
        yield Row(region_id=key[0], last_micros=micros, reported_ms=now, staleness_seconds=age / 1000)

    def close(self) -> None:
        pass


def staleness_stream(stream: DataFrame, regions: DataFrame, every: int = 30) -> DataFrame:
    """Every ``every`` seconds the age of each region's newest event, silent regions included.

    ``regions(region_id)`` are known from the start; their timers run whether or not
    events come. ``(region_id, last_time, reported_at, staleness_seconds)``; ``last_time``
    is null for a region without any event, whose age counts from the start.
    """
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz '1970-01-01', time)").alias("micros")
    sent = stream.where("region_id is not null").select("region_id", micros)
    known = regions.select("region_id").distinct().groupBy("region_id")
    schema = "region_id string, last_micros long, reported_ms long, staleness_seconds double"
    out = sent.groupBy("region_id").transformWithState(_Silence(every), schema, "append", "processingTime", known)
    utc = "timestamp_ntz '1970-01-01' + make_dt_interval(0, 0, 0, CAST(CAST({} AS DECIMAL(20, 0)) / {} AS DECIMAL(18, 6)))"
    return out.select(
        "region_id", F.expr(utc.format("last_micros", 1_000_000)).alias("last_time"),
        F.expr(utc.format("reported_ms", 1_000)).alias("reported_at"), "staleness_seconds",
    )
