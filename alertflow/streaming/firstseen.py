"""First-seen row of every object, the same whatever the batch cut.

``dropDuplicates`` keeps the row a task happens to meet first in the first batch
that holds the object; a replay cut into other batches can keep another one. Here
the earliest event of an object wins, by event time and then by the given order.
The state of an object is its earliest row so far and an event-time timer at that
row's time: once the watermark has passed it no earlier event can come, the timer
fires and the row goes out, once. What stays is a mark that the object is done,
cleared by a second timer after ``forget`` of event time (``None``: never).

The session's state store must be RocksDB's (``session.DEFAULT_CONF``), which has the timers.

Rows later than the watermark's delay are dropped by Spark before they get here.
Rows with a null key take no part, but their time advances the watermark: a topic
that falls silent is completed by such a heartbeat.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

TIME = "_time_us"  # event time in microseconds
CONTENT = "_content"  # hash of the row, the last tie-break


class FirstSeen(StatefulProcessor):
    """One object: hold the earliest row, give it out when the watermark passes it, remember that."""

    def __init__(self, columns: T.StructType, order: list[str], forget_ms: int | None):
        self.columns, self.forget_ms = columns, forget_ms
        self.at = [columns.names.index(c) for c in (TIME, *order, CONTENT)]

    def _rank(self, row) -> tuple:
        """What rows of an object are ordered by; nulls come last."""
        return tuple((row[i] is None, row[i]) for i in self.at)

    def _timer(self, row) -> int:
        return -(-row[self.at[0]] // 1000)  # the first whole millisecond not before the row

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.columns)
        self.done = handle.getValueState("done", T.StructType([T.StructField("time_us", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        if key[0] is None or self.done.exists():
            return
        best = min((tuple(r[c] for c in self.columns.names) for r in rows), key=self._rank, default=None)
        if best is None:
            return
        if self.held.exists():
            old = self.held.get()
            if self._rank(old) <= self._rank(best):
                return
            self.handle.deleteTimer(self._timer(old))
        self.held.update(best)
        self.handle.registerTimer(self._timer(best))
        return
        yield  # a generator without rows

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.done.exists():
            self.done.clear()
            return
        row = self.held.get()
        self.held.clear()
        self.done.update((row[self.at[0]],))
        if self.forget_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + self.forget_ms)
        yield Row(**dict(zip(self.columns.names, row)))

    def close(self) -> None:
        pass


def first_seen(df: DataFrame, key: str, time_col: str, watermark: str, order: list[str] = (),
               forget: dt.timedelta | None = None) -> DataFrame:
    """The earliest row of each ``key``, whole, emitted when the watermark has passed it.

    ``order`` settles equal times (then the row's content). A row given out stays
    the object's only one for ``forget`` of event time, or for good.
    """
    names = df.columns
    rows = df.withWatermark(time_col, watermark)
    rows = rows.select(*names, F.unix_micros(F.col(time_col)).alias(TIME), F.xxhash64(*[F.col(c) for c in names]).alias(CONTENT))
    keyed = rows.withColumn("_key", F.col(key)).groupBy("_key")
    kept = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    forget_ms = None if forget is None else int(forget.total_seconds() * 1000)
    out = keyed.transformWithState(FirstSeen(kept, list(order), forget_ms), kept, "Append", "EventTime")
    return out.select(*names)
