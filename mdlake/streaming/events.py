"""Event-time operators: bars of longer intervals, and two feeds that meet within a delay.

Times are zoned timestamps, as watermarks need. State lives in Spark's state store, is split by key, and is
dropped once the watermark has passed it, so its size follows the delay and not the length of the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def resampled(bars: DataFrame, by: Sequence[str], time: str, width: str, delay: str | None = None) -> DataFrame:
    """Bars (open, high, low, close, volume, amount) of intervals ``width`` from shorter ones.

    The first bar of an interval gives its open, the last one its close. On a stream ``delay`` says how late a
    bar may come; an interval is put out once, when the watermark has passed its end, and later bars are
    dropped and counted (``late_rows``). Without ``delay``, for a frame that has its watermark already or for a batch,
    rows are taken as they are; so a stream can be resampled in steps, and a batch gives what a stream gives.
    """
    timed = bars.withWatermark(time, delay) if delay else bars
    return (
        timed.groupBy(F.window(time, width).alias("window"), *by)
        .agg(
            F.min_by("open", time).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", time).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("amount").alias("amount"),
        )
        .withColumn(time, F.window_time("window"))
    )


def with_start(resampled_bars: DataFrame, time: str) -> DataFrame:
    """The interval's start in place of the window and of the time that marks its end."""
    return resampled_bars.withColumn(time, F.col("window.start")).drop("window")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark has shut out, as far as the query's progress reaches back.

    Rows of one key, interval and micro-batch that were summed before they met the state count once.
    """
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


def met_feeds(
    main: DataFrame, extra: DataFrame, keys: Sequence[str], time: str, delay: str, extra_delay: str | None = None
) -> DataFrame:
    """Full outer join of two feeds by key and event time, each of which may come ``delay`` after the other.

    A row that finds its partner is put out at once. One whose partner has not come when both watermarks have
    passed its time is put out alone. Keys and time are those of whichever side is there; other columns that
    both feeds carry are an error, as neither feed can be known to win before both are there.
    """
    clash = (set(main.columns) & set(extra.columns)) - {*keys, time}
    if clash:
        raise ValueError(f"columns in both feeds: {sorted(clash)}")
    left = main.withWatermark(time, delay).alias("m")
    right = extra.withWatermark(time, extra_delay or delay).alias("x")
    same = F.col(f"m.{time}") == F.col(f"x.{time}")
    for k in keys:
        same &= F.col(f"m.{k}") == F.col(f"x.{k}")
    shared = [F.coalesce(f"m.{c}", f"x.{c}").alias(c) for c in (*keys, time)]
    own = [F.col(f"m.{c}") for c in main.columns if c not in (*keys, time)]
    other = [F.col(f"x.{c}") for c in extra.columns if c not in (*keys, time)]
    return left.join(right, same, "full_outer").select(*shared, *own, *other)


def to_files(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is final to parquet files until the landed files are consumed."""
    return (
        frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
