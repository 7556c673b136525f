"""Online and offline edges of every device, by timers on event time.

A device goes online with a reading after a silence, and offline once the watermark has
passed its last reading by ``quiet``. Its state is three numbers; after ``forget`` of
silence it is dropped, and a device that is heard again begins anew.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from fleetgauge.rules import RETENTION_MINUTES
from fleetgauge.schema import KEY

EDGES = f"{KEY} int, at_micros long, online int"
ONE = 1_000_000
Edge = Row(KEY, "at_micros", "online")


class DeviceEdges(StatefulProcessor):
    """State: the last reading's time, whether the device is online, and the timer that is set."""

    def __init__(self, quiet_seconds: float, forget_seconds: float):
        self.quiet = int(quiet_seconds * ONE)
        self.forget = int(forget_seconds * ONE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.device = handle.getValueState("device", "last long, online boolean, timer long")

    def _set_timer(self, last: int, online: bool, before: int | None, micros: int) -> None:
        """Timers count milliseconds; one is set for the first whole one not before its time."""
        timer = -(-micros // 1000)
        if before != timer:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(timer)
        self.device.update((last, online, timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, online, timer = self.device.get() if self.device.exists() else (None, False, None)
        for at in sorted(r.micros for r in rows):
            if online and at - last > self.quiet:
                yield Edge(key[0], last + self.quiet, 0)
                online = False
            if not online:
                # What comes late and before the last reading brings nobody online.
                if last is not None and at <= last:
                    continue
                yield Edge(key[0], at, 1)
                online = True
            last = at if last is None else max(last, at)
        self._set_timer(last, online, timer, last + (self.quiet if online else self.forget))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.device.exists():
            return
        last, online, _ = self.device.get()
        if online:
            yield Edge(key[0], last + self.quiet, 0)
            if last + self.forget > timerValues.getCurrentWatermarkInMs() * 1000:
                self._set_timer(last, False, None, last + self.forget)
                return
        self.device.clear()

    def close(self) -> None:
        pass


def online_edges(
    readings: DataFrame,
    quiet_minutes: float = RETENTION_MINUTES,
    forget_minutes: float = 24 * 60,
    delay: str = "10 minutes",
) -> DataFrame:
    """``DeviceId``, ``changed_at`` and ``online``: 1 when a device is heard from, 0 once it is silent for the interval.

    ``changed_at`` is the reading's time, or the last one's plus the interval. Needs the RocksDB state store.
    Rows without a device or event time, or later than ``delay``, have no part.
    """
    if forget_minutes <= quiet_minutes:
        raise ValueError("a device cannot be forgotten before it is offline")
    placed = readings.filter(F.col(KEY).isNotNull() & F.col("event_ts").isNotNull())
    timed = placed.select(KEY, "event_ts", F.unix_micros("event_ts").alias("micros")).withWatermark("event_ts", delay)
    edges = timed.groupBy(KEY).transformWithState(
        DeviceEdges(quiet_minutes * 60, forget_minutes * 60), StructType.fromDDL(EDGES), "append", "EventTime"
    )
    return edges.select(KEY, F.timestamp_micros("at_micros").alias("changed_at"), "online")
