"""Conversions in order, as a stateful stream per user.

A conversion's predecessor and number are final once no earlier one can arrive.  So each user's conversions wait in a list until
the watermark has passed them, whatever order they came in; a timer then emits them sorted, each with its predecessor and
number.  What comes after its place has been emitted goes to a side output (``late``) and changes nothing.

Per user the state holds the conversions the watermark has not passed, and the last one emitted, which is
forgotten ``forget_days`` later.  A user who converts again after that starts anew.  Every access to state is a message to
the JVM, so a user has one timer at a time, kept with the last conversion, and what is due to be forgotten is not stored.

Needs ``spark.sql.streaming.stateStore.providerClass`` set to the RocksDB provider (``use_rocksdb``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_MILLIS = 86_400_000
_OUT = Row("user_id", "conversion_session_id", "at", "revenue", "event_id", "previous", "conversion_index", "late")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class InOrder(StatefulProcessor):
    """Times are microseconds; ``id_type`` is that of event ids, which break ties."""

    def __init__(self, id_type: str, forget_days: int):
        self.id_type, self.forget = id_type, forget_days * DAY_MILLIS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"at long, event {self.id_type}, session string, revenue string")
        # The last conversion emitted, if any, and the time of the user's timer.
        self.place = handle.getValueState("place", f"at long, event {self.id_type}, number long, timer long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        *last, timer = self.place.get() or (None,) * 4
        new, late = [], []
        for r in rows:
            row = (r["at"], r["event_id"], r["conversion_session_id"], r["revenue"])
            (late if last[0] is not None and row[:2] <= (last[0], last[1]) else new).append(row)
        if new:
            self.waiting.appendList(new)
            # Rows the watermark has passed already, but nothing emitted, are due at once.
            first = min(r[0] for r in new) // 1000 + 1
            if timer is None or first < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self._wait(last, first)
        if late:
            yield from self._rows(key, [(*row, None, None, True) for row in late])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        rows = sorted(self.waiting.get(), key=lambda r: (r[0], r[1]))
        due = [r for r in rows if r[0] // 1000 < passed]
        rest = rows[len(due):]
        last = (self.place.get() or (None,) * 4)[:3]
        out = []
        for at, event, session, revenue in due:
            out.append((at, event, session, revenue, last[0], 1 if last[0] is None else last[2] + 1, False))
            last = (at, event, out[-1][5])
        if due:
            if rest:
                self.waiting.put([tuple(r) for r in rest])
            else:
                self.waiting.clear()
        if rest:
            self._wait(last, rest[0][0] // 1000 + 1)
        elif last[0] is not None and last[0] // 1000 + self.forget >= passed:
            self._wait(last, last[0] // 1000 + self.forget + 1)
        else:
            self.place.clear()
        yield from self._rows(key, out)

    def _wait(self, last, timer: int) -> None:
        self.place.update((*last, timer))
        self.handle.registerTimer(timer)

    def _rows(self, key, rows: list[tuple]) -> Iterator[Row]:
        for at, event, session, revenue, previous, number, late in rows:
            yield _OUT(key[0], session, at, revenue, event, previous, number, late)

    def close(self) -> None:
        pass


def conversions_in_order(found: DataFrame, watermark: str, forget_days: int = 400) -> DataFrame:
    """The stream ``found`` (user_id, conversion_session_id, converted_at, conversion_revenue, event_id) with each conversion's
    predecessor and number, emitted when the watermark has passed it; ``late`` rows have neither.

    Rows without a user or a time are left out.
    """
    id_type = found.schema["event_id"].dataType.simpleString()
    id_type = id_type if id_type in ("bigint", "int") else "string"
    revenue = found.schema["conversion_revenue"].dataType
    # The time goes on as a number, so that late rows reach the processor instead of being dropped before it.
    rows = found.filter("user_id is not null and converted_at is not null").withWatermark("converted_at", watermark).select(
        "user_id", "conversion_session_id", F.unix_micros("converted_at").alias("at"),
        F.col("conversion_revenue").cast("string").alias("revenue"), F.col("event_id").cast(id_type).alias("event_id"))
    schema = f"user_id string, conversion_session_id string, at long, revenue string, event_id {id_type}, previous long, conversion_index long, late boolean"
    ordered = rows.groupBy("user_id").transformWithState(InOrder(id_type, forget_days), schema, "Append", "EventTime")
    return ordered.select(
        "user_id", "conversion_session_id", F.timestamp_micros("at").alias("converted_at"), F.col("revenue").cast(revenue).alias("conversion_revenue"),
        F.timestamp_micros("previous").alias("previous_conversion_at"), "conversion_index", "event_id", "late")
