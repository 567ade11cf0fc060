"""Work units of an increment, as rows.

Windows are generated inside each row with ``sequence`` and ``explode``; no join is needed to pair
codes with windows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

# Longest span of one window of the index feed, rows per page, last allowed offset.
WINDOW_SPAN_DAYS = 90
PAGE_ROWS = 6000
MAX_OFFSET = 96000
LIMIT_TYPES = ("U", "D", "Z")


def row_cap(page_rows: int = PAGE_ROWS, max_offset: int = MAX_OFFSET) -> int:
    """Rows from which a window needs pages beyond the last allowed offset."""
    return (max_offset // page_rows + 1) * page_rows


def fixed_windows(df: DataFrame, start: Column, end: Column, span_days: int = WINDOW_SPAN_DAYS) -> DataFrame:
    """Windows [w, w + span] covering [start, end] without gap or overlap; span 0 gives single days."""
    step = F.make_dt_interval(F.lit(span_days + 1))
    starts = F.when(start <= end, F.sequence(start, end, step))
    return (
        df.withColumn("_end", end)
        .withColumn("window_start", F.explode(starts))
        .withColumn("window_end", F.least(F.date_add("window_start", span_days), F.col("_end")))
        .drop("_end")
    )


def month_windows(df: DataFrame, start: Column, end: Column, clamp: bool) -> DataFrame:
    """Calendar-month windows; the first one starts on day 1, or on ``start`` when clamped."""
    firsts = F.when(start <= end, F.sequence(F.trunc(start, "MM"), end, F.expr("interval 1 month")))
    opened = df.withColumn("_start", start).withColumn("_end", end).withColumn("window_start", F.explode(firsts))
    closed = opened.withColumn("window_end", F.least(F.last_day("window_start"), F.col("_end")))
    if clamp:
        closed = closed.withColumn("window_start", F.greatest("window_start", "_start"))
    return closed.drop("_start", "_end")


def per_limit_type(df: DataFrame) -> DataFrame:
    """One unit per limit type of the limit-list feed."""
    return df.withColumn("limit_type", F.explode(F.array(*[F.lit(t) for t in LIMIT_TYPES])))


def bisect_windows(daily_counts: DataFrame, by: list[str], cap: int, end: date | None = None) -> DataFrame:
    """Month windows, up to ``end``, halved until each stays under ``cap`` rows or is a single day.

    ``daily_counts`` has one row per group and day (``day``, ``n``). A month's counts travel as one
    array of at most 31 numbers, so all five possible halvings are row-local. A single day at or
    over the cap is flagged, since it cannot be split further.
    """
    month = F.trunc("day", "MM")
    slot = F.struct(F.dayofmonth("day").alias("d"), F.col("n").alias("n"))
    if end is not None:
        daily_counts = daily_counts.where(F.col("day") <= F.lit(end))
    months = daily_counts.groupBy(*by, month.alias("month")).agg(F.collect_list(slot).alias("slots"))
    last = F.last_day("month") if end is None else F.least(F.last_day("month"), F.lit(end))
    days = F.dayofmonth(last)
    counted = F.transform(
        F.sequence(F.lit(1), days),
        lambda d: F.aggregate(
            F.filter("slots", lambda s: s["d"] == d), F.lit(0).cast("bigint"), lambda acc, s: acc + s["n"]
        ),
    )
    level = months.select(*by, "month", counted.alias("counts"), F.lit(1).alias("lo"), days.alias("hi"))
    rows = F.aggregate(
        F.slice("counts", F.col("lo"), F.col("hi") - F.col("lo") + 1), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    middle = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")
    for _ in range(5):
        too_big = (rows >= cap) & (F.col("lo") < F.col("hi"))
        halves = F.array(
            F.struct(F.col("lo").alias("lo"), middle.alias("hi")),
            F.struct((middle + 1).alias("lo"), F.col("hi").alias("hi")),
        )
        whole = F.array(F.struct(F.col("lo").alias("lo"), F.col("hi").alias("hi")))
        level = level.withColumn("_w", F.explode(F.when(too_big, halves).otherwise(whole))).select(
            *by, "month", "counts", F.col("_w.lo").alias("lo"), F.col("_w.hi").alias("hi")
        )
    return level.select(
        *by,
        F.date_add("month", F.col("lo") - 1).alias("window_start"),
        F.date_add("month", F.col("hi") - 1).alias("window_end"),
        rows.alias("n_rows"),
        (rows >= cap).alias("over_cap"),
    )
