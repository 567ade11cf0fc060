"""Sessions of instruments, closed by timers.

Bars of a code and day are held in keyed state until the watermark passes the close of the session. A timer per
key then puts out the held bars as one row and drops the state; Spark makes a row of each five-minute slot of it. So
rows of unfinished sessions wait by key in the state store, and are not rewritten with every micro-batch. A key
holds at most the bars of one session; a repeated bar replaces the earlier one.

This needs the RocksDB state store, which ``use_rocksdb`` selects.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, time, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.dates import SESSION_CLOSE, SESSION_OPEN

STEP = timedelta(minutes=5)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSED = "ts_code string, day date, held map<bigint, double>"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set(PROVIDER, ROCKSDB)


def session_slots(day: Any) -> Iterator[datetime]:
    """Starts of the slots of a day's session, both ends included, in UTC."""
    at = datetime.combine(day, time.fromisoformat(SESSION_OPEN), timezone.utc)
    close = datetime.combine(day, time.fromisoformat(SESSION_CLOSE), timezone.utc)
    while at <= close:
        yield at
        at += STEP


def slots_of(day: Column) -> Column:
    """``session_slots`` of a column of days, in seconds."""
    midnight = datetime(1970, 1, 1, tzinfo=timezone.utc)
    offsets = [int((at - midnight).total_seconds()) for at in session_slots(midnight.date())]
    return F.transform(F.array(*map(F.lit, offsets)), lambda seconds: F.unix_date(day).cast("long") * 86400 + seconds)


class SessionProcessor(StatefulProcessor):
    """Holds the bars of one (code, day) by slot until the session has closed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        slot = T.StructType([T.StructField("slot", T.LongType())])
        held = T.StructType([T.StructField("close", T.DoubleType())])
        self.held = handle.getMapState("held", slot, held)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        fresh = not self.held.exists()
        for row in rows:
            self.held.updateValue((int(row.slot),), (row.close,))
        if fresh:
            close = datetime.combine(key[1], time.fromisoformat(SESSION_CLOSE), timezone.utc) + STEP
            self.handle.registerTimer(int(close.timestamp() * 1000))
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        yield Row(ts_code=key[0], day=key[1], held={k[0]: v[0] for k, v in self.held.iterator()})
        self.held.clear()

    def close(self) -> None:
        pass


def closed_sessions(bars: DataFrame, delay: str) -> DataFrame:
    """(ts_code, day, trade_time, close, kind) of every closed session: kind is ``bar`` or ``missing``.

    ``bars`` has ts_code, trade_time (a zoned timestamp, UTC session) and close. A bar counts for the slot that it lies
    in; bars outside of the session are left out, and bars that come after the watermark has passed their session
    are dropped.
    """
    of_day = F.date_format("trade_time", "HH:mm:ss")
    inside = bars.where(of_day.between(SESSION_OPEN, SESSION_CLOSE)).withWatermark("trade_time", delay)
    seconds = int(STEP.total_seconds())
    slot = (F.floor(F.unix_timestamp("trade_time") / seconds) * seconds).alias("slot")
    keyed = inside.select("ts_code", F.col("trade_time").cast("date").alias("day"), slot, "trade_time", "close")
    closed = keyed.groupBy("ts_code", "day").transformWithState(SessionProcessor(), T.StructType.fromDDL(CLOSED), "Append", "EventTime")
    at = F.col("_slot")
    return closed.select("*", F.explode(slots_of(F.col("day"))).alias("_slot")).select(
        "ts_code",
        "day",
        F.timestamp_seconds(at).alias("trade_time"),
        F.try_element_at("held", at).alias("close"),
        F.when(F.map_contains_key("held", at), "bar").otherwise("missing").alias("kind"),
    )
