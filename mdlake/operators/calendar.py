"""Trading-calendar operators.

Every relation here holds at most one row per calendar date and exchange, so its size is bounded
by the date range whatever the volume of market data.
"""

from __future__ import annotations

from datetime import date, time

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# End of session plus buffer, and how far back the previous session may lie.
SESSION_DONE = time(15, 5)
PREVIOUS_WITHIN_DAYS = 10


def open_days(cal: DataFrame, exchange: str = "SSE", start: date | None = None, end: date | None = None) -> DataFrame:
    """Open days of an exchange within [start, end], as one date column ``cal_date``."""
    days = cal.where((F.col("exchange") == exchange) & (F.col("is_open") == 1))
    if start is not None:
        days = days.where(F.col("cal_date") >= F.lit(start))
    if end is not None:
        days = days.where(F.col("cal_date") <= F.lit(end))
    return days.select("cal_date")


def cutoff_last_open_days(cal: DataFrame, keep: int, end: date, exchange: str = "SSE") -> DataFrame:
    """One row ``cutoff``: the earliest of the last ``keep`` open days, NULL when there are fewer."""
    newest = open_days(cal, exchange, end=end).orderBy(F.desc("cal_date")).limit(max(keep, 0))
    enough = (F.count(F.lit(1)) == keep) & F.lit(keep > 0)
    return newest.agg(F.when(enough, F.min("cal_date")).alias("cutoff"))


def cutoffs(cal: DataFrame, ends: DataFrame, keeps: list[int], exchange: str = "SSE") -> DataFrame:
    """Cutoffs of several retention lengths at several end dates: (end_date, keep_open_days, cutoff).

    Open days are numbered once; a cutoff is then an equality lookup of ``position - keep + 1``.
    """
    numbered = open_days(cal, exchange).withColumn("pos", F.row_number().over(W.orderBy("cal_date")))
    spans = numbered.withColumn("until", F.lead("cal_date").over(W.orderBy("cal_date")))
    last = F.coalesce(F.date_sub("until", 1), F.greatest("cal_date", F.lit(ends.agg(F.max("end_date")).scalar())))
    position = spans.select(F.explode(F.sequence("cal_date", last)).alias("end_date"), "pos")
    wanted = (
        ends.distinct()
        .withColumn("keep_open_days", F.explode(F.array(*[F.lit(k) for k in keeps])))
        .join(position, "end_date", "left")
        .withColumn("target", F.when(F.col("keep_open_days") > 0, F.col("pos") - F.col("keep_open_days") + 1))
    )
    found = numbered.select(F.col("pos").alias("target"), F.col("cal_date").alias("cutoff"))
    return wanted.join(found, "target", "left").select("end_date", "keep_open_days", "cutoff")


def latest_open_day(cal: DataFrame, as_of: date, exchange: str = "SSE") -> DataFrame:
    """One row: latest open day up to ``as_of``, as a date and as compact text."""
    newest = F.max("cal_date")
    return open_days(cal, exchange, end=as_of).agg(
        newest.alias("latest_open"), F.date_format(newest, "yyyyMMdd").alias("latest_open_text")
    )


def previous_open_days(cal: DataFrame, exchange: str = "SSE") -> DataFrame:
    """Each open day with the open day before it; ``agrees`` checks the vendor's own column, if present."""
    by_day = W.partitionBy("exchange").orderBy("cal_date")
    vendor = ["pretrade_date"] if "pretrade_date" in cal.columns else []
    days = cal.where((F.col("exchange") == exchange) & (F.col("is_open") == 1)).select("exchange", "cal_date", *vendor)
    days = days.withColumn("prev_open", F.lag("cal_date").over(by_day))
    return days.withColumn("agrees", F.col("prev_open").eqNullSafe(F.col("pretrade_date"))) if vendor else days


def sessions_before(cal: DataFrame, exchange: str = "SSE") -> DataFrame:
    """For each date within reach of an open day: the last open day strictly before it.

    Each open day is offered to the dates that follow it, and the newest offer wins; this needs
    neither a range join nor a window.
    """
    reach = F.sequence(F.date_add("cal_date", 1), F.date_add("cal_date", PREVIOUS_WITHIN_DAYS))
    offers = open_days(cal, exchange).select(F.explode(reach).alias("day"), "cal_date")
    return offers.groupBy("day").agg(F.max("cal_date").alias("prev_session"))


def last_completed_day(
    requests: DataFrame,
    cal: DataFrame,
    end: Column,
    now: Column,
    explicit: Column | None = None,
    exchange: str = "SSE",
    output: str = "done_day",
) -> DataFrame:
    """Resolve requested end dates to the last finished session.

    An explicit end, an end other than today, or a time after the close keeps the end; otherwise the
    previous open day within ten days is used, or simply the day before.
    """
    finished = (end != now.cast("date")) | (F.date_format(now, "HH:mm:ss") >= F.lit(SESSION_DONE.isoformat()))
    keep = finished if explicit is None else explicit | finished
    before = sessions_before(cal, exchange)
    return (
        requests.withColumn("_end", end)
        .join(F.broadcast(before.withColumnRenamed("day", "_end")), "_end", "left")  # one row per date
        .withColumn(output, F.when(keep, F.col("_end")).otherwise(F.coalesce("prev_session", F.date_sub("_end", 1))))
        .drop("_end", "prev_session")
    )


def on_open_days(facts: DataFrame, cal: DataFrame, day: Column, exchange: str = "SSE") -> DataFrame:
    """Keep facts whose day is an open day (left semi join on the bounded day list)."""
    days = open_days(cal, exchange).select(F.col("cal_date").alias("_open_day"))
    return facts.join(F.broadcast(days), day == F.col("_open_day"), "left_semi")


def calendar_depth(cal: DataFrame, needs: DataFrame, end: date, exchange: str = "SSE") -> DataFrame:
    """Per table: open days wanted and available, and the first calendar day to load."""
    available = open_days(cal, exchange, end=end).agg(F.count(F.lit(1)).alias("open_days")).scalar()
    years = F.greatest(F.lit(5), F.floor(F.col("keep_open_days") / 200).cast("int") + 2)
    return needs.select(
        "table_name",
        "keep_open_days",
        years.alias("years"),
        F.date_sub(F.lit(end), years * 365).alias("load_from"),
        available.alias("open_days"),
        (available >= F.col("keep_open_days")).alias("enough"),
    )
