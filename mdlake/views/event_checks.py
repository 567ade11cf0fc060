"""Stored sketches and event-time streams, each compared with exact SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import sketches
from ..session import child_names, local_frame, scratch_path
from ..streaming import events, sessions
from ..streaming.ingest import landed_stream
from .base import SQL_BARS, bars, check, code, sql_code, table

# Days on which the landed files of the streams end, and what their watermarks allow.
CUTS = (date(2024, 1, 9), date(2024, 1, 17), date(2024, 1, 25))
DELAY_HOURS = 6


# --- sketches -------------------------------------------------------------------------------------------


@check(
    "sketch_states",
    """with e as (select event_type, user_id, event_id, value from events),
groups as (select event_type, count(*) as n_rows, count(distinct event_id) as n_events, count(distinct user_id) as n_users from e group by 1
           union all select 'all', count(*), count(distinct event_id), count(distinct user_id) from e)
select *, true as events_within, true as users_within, true as median_within, true as p90_within from groups""",
)
def sketch_states(spark, sf_dir):
    """Daily states are stored in two runs and merged to types and to a total; each estimate is compared with the
    exact number: distinct counts within 6 %, quantiles within 5 % of the ranks."""
    ev = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    path = scratch_path(spark, "states")
    distinct, quantile = {"events": "event_id", "users": "user_id"}, {"spread": "value"}
    for part in (ev.where(F.col("day") < F.lit(CUTS[1])), ev.where(F.col("day") >= F.lit(CUTS[1]))):
        sketches.states(part, ["event_type", "day"], distinct, quantile).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    by_type = sketches.merged(stored, ["event_type"], list(distinct), list(quantile))
    total = sketches.merged(by_type.withColumn("event_type", F.lit("all")), ["event_type"], list(distinct), list(quantile))
    read = sketches.estimates(by_type.unionByName(total), list(distinct), list(quantile), [0.5, 0.9])
    both = ev.select("event_type", "user_id", "event_id", "value").union(ev.select(F.lit("all"), "user_id", "event_id", "value"))
    estimate = read.select("event_type", "events", "users", F.col("spread")[0].alias("median"), F.col("spread")[1].alias("p90"))
    compared = both.join(F.broadcast(estimate), "event_type").groupBy("event_type").agg(  # one row per type
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("event_id").alias("n_events"),
        F.count_distinct("user_id").alias("n_users"),
        F.max("events").alias("events"),
        F.max("users").alias("users"),
        *(F.avg((F.col("value") <= F.col(q)).cast("double")).alias(f"{q}_up_to") for q in ("median", "p90")),
        *(F.avg((F.col("value") < F.col(q)).cast("double")).alias(f"{q}_below") for q in ("median", "p90")),
    )

    def near(name, exact):
        return (F.abs(F.col(name) - F.col(exact)) <= 0.06 * F.col(exact)).alias(f"{name}_within")

    def ranked(name, rank):
        return ((F.col(f"{name}_below") <= rank + 0.05) & (F.col(f"{name}_up_to") >= rank - 0.05)).alias(f"{name}_within")

    return compared.select(
        "event_type", "n_rows", "n_events", "n_users", near("events", "n_events"), near("users", "n_users"),
        ranked("median", 0.5), ranked("p90", 0.9),
    )


# --- streams --------------------------------------------------------------------------------------------


def _land_in_steps(rows, day, path, n_files):
    """One set of ``n_files`` files per span of days, in the order of time; a file's rows are in no order.

    Tasks write the files of a set beside each other. Spark writes none for a task without rows, so files without rows
    fill up a set of few rows: every set has the same number, by which a stream takes up whole sets.
    """
    spark = rows.sparkSession
    bounds = [date(1900, 1, 1), *CUTS, date(2999, 1, 1)]
    for step, (first, last) in enumerate(zip(bounds, bounds[1:]), start=1):
        span = rows.where((day >= F.lit(first)) & (day < F.lit(last)))
        span.repartition(n_files, *rows.columns).write.mode("append").parquet(path)
        landed = sum(name.endswith(".parquet") for name in child_names(spark, path))
        for _ in range(step * n_files - landed):
            local_frame(spark, [], rows.schema).coalesce(1).write.mode("append").parquet(path)


def _stream_of(spark, rows, day, path):
    n_files = spark.sparkContext.defaultParallelism  # all cores write and read a set
    _land_in_steps(rows, day, path, n_files)
    return landed_stream(spark, path, rows.schema, files_per_batch=n_files)


def _zoned_bars(spark, sf_dir):
    return bars(spark, sf_dir).withColumn("trade_time", F.col("trade_time").cast("timestamp"))


# what a stream has put out once all files are read: intervals whose end the watermark has passed
SQL_FINAL = f"(select time_bucket(interval 1 microsecond, max(trade_time)) - interval {DELAY_HOURS} hours as mark from bars)"


def sql_resampled(width: str) -> str:
    return f"""select ts_code, time_bucket(interval {width}, trade_time) as trade_time, arg_min(open, trade_time) as open, max(high) as high,
 min(low) as low, arg_max(close, trade_time) as close, sum(volume)::bigint as volume, sum(amount)::bigint as amount from bars group by 1, 2"""


@check(
    "stream_resample",
    f"""with {SQL_BARS}, half as ({sql_resampled('30 minutes')}), final as {SQL_FINAL}
select * from half where trade_time + interval 30 minutes <= (select mark from final)""",
)
def stream_resample(spark, sf_dir):
    """Five-minute bars to half-hour bars, put out once each."""
    root = scratch_path(spark, "resample")
    source = _zoned_bars(spark, sf_dir)
    stream = _stream_of(spark, source, F.col("trade_time").cast("date"), f"{root}/in")
    out = events.with_start(events.resampled(stream, ["ts_code"], "trade_time", "30 minutes", f"{DELAY_HOURS} hours"), "trade_time")
    events.to_files(out, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out").withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz"))


@check(
    "stream_resample_steps",
    f"""with {SQL_BARS}, day as ({sql_resampled('1 day')}), final as {SQL_FINAL}
select * from day where trade_time + interval 1 day <= (select mark from final)""",
)
def stream_resample_steps(spark, sf_dir):
    """Five-minute bars to half-hour bars to daily bars, in one stream."""
    root = scratch_path(spark, "resample-steps")
    source = _zoned_bars(spark, sf_dir)
    stream = _stream_of(spark, source, F.col("trade_time").cast("date"), f"{root}/in")
    half = events.resampled(stream, ["ts_code"], "trade_time", "30 minutes", f"{DELAY_HOURS} hours").drop("window")
    out = events.with_start(events.resampled(half, ["ts_code"], "trade_time", "1 day"), "trade_time")
    events.to_files(out, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out").withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz"))


@check(
    "stream_met_feeds",
    f"""with clicks as (select {sql_code('user_id')} as ts_code, cast(ts as date) as d, count(*) as n_clicks from events where event_type = 'click' group by 1, 2),
views as (select {sql_code('user_id')} as ts_code, cast(ts as date) as d, sum(event_id)::bigint as view_ids from events where event_type = 'view' group by 1, 2),
mark as (select least((select max(d) from clicks), (select max(d) from views)) - 1 as day)
select ts_code, d as trade_date, n_clicks, view_ids from clicks full join views using (ts_code, d)
where (n_clicks is not null and view_ids is not null) or d <= (select day from mark)""",
)
def stream_met_feeds(spark, sf_dir):
    """Two feeds of a day that land in files of different sizes; rows without a partner come when both watermarks have passed."""
    root = scratch_path(spark, "feeds")
    ev = table(spark, sf_dir, "events").select(
        code(F.col("user_id")).alias("ts_code"), F.col("ts").cast("date").cast("timestamp").alias("day"), "event_type", "event_id"
    )
    clicks = ev.where("event_type = 'click'").groupBy("ts_code", "day").agg(F.count(F.lit(1)).alias("n_clicks"))
    views = ev.where("event_type = 'view'").groupBy("ts_code", "day").agg(F.sum("event_id").alias("view_ids"))
    main = _stream_of(spark, clicks, F.col("day").cast("date"), f"{root}/main")
    extra = _stream_of(spark, views, F.col("day").cast("date"), f"{root}/extra")
    out = events.met_feeds(main, extra, ["ts_code"], "day", "1 day")
    events.to_files(out, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    found = spark.read.schema(out.schema).parquet(f"{root}/out")
    return found.select("ts_code", F.col("day").cast("date").alias("trade_date"), "n_clicks", "view_ids")


@check(
    "stream_sessions",
    f"""with {SQL_BARS}, inside as (select ts_code, cast(trade_time as date) as day, trade_time, close from bars
  where cast(trade_time as time) between time '09:30:00' and time '15:00:00'),
slots as (select day + time '09:30:00' + s * interval 5 minutes as trade_time, day from (select distinct day from inside), range(67) t(s)),
final as (select max(trade_time) - interval {DELAY_HOURS} hours as mark from inside)
select k.ts_code, k.day, s.trade_time, i.close, case when i.trade_time is null then 'missing' else 'bar' end as kind
from (select distinct ts_code, day from inside) k join slots s using (day) left join inside i on i.ts_code = k.ts_code and i.trade_time = s.trade_time
where k.day + time '15:05:00' <= (select mark from final)""",
)
def stream_sessions(spark, sf_dir):
    """Bars held by code and day until their session has closed, with the slots that had none."""
    root = scratch_path(spark, "sessions")
    sessions.use_rocksdb(spark)
    source = _zoned_bars(spark, sf_dir).select("ts_code", "trade_time", "close")
    stream = _stream_of(spark, source, F.col("trade_time").cast("date"), f"{root}/in")
    out = sessions.closed_sessions(stream, f"{DELAY_HOURS} hours")
    events.to_files(out, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out").withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz"))
