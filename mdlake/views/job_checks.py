"""Sources, written tables, whole jobs and streams, run in a scratch folder over whole tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F, types as T

from ..functions import dates
from ..operators import cleaning
from ..operators.retention import retention_split
from ..operators.windows import PAGE_ROWS
from ..plans import bars as bar_jobs, update as jobs
from ..plans.specs import BARS, SPECS
from ..session import checkpointed, delete_folder, local_frame, scratch_path
from ..sources import bars_csv, landed
from ..sources.lake import LakeTable
from ..streaming import ingest as streaming
from .base import (
    SQL_BARS,
    SQL_CAL,
    SQL_EVENT_CAL,
    bars,
    basic,
    calendar,
    check,
    code,
    daily,
    event_calendar,
    instruments,
    sql_code,
    sql_shard,
    table,
)
from .merge_checks import SQL_MERGED

NOW = datetime(2024, 1, 31, 16, 0)
END = date(2000, 12, 31)


def _text(df):
    """Landed form: compact dates, everything else as text."""
    casts = {}
    for f in df.schema:
        column = F.col(f.name)
        casts[f.name] = dates.compact_date(column) if isinstance(f.dataType, T.DateType) else column.cast("string")
    return df.withColumns(casts)


def _land(df, root, feed):
    _text(df).write.mode("append").json(f"{root}/{feed}")


# --- sources ----------------------------------------------------------------------------------------


@check(
    "read_landed",
    f"""select {sql_code('user_id')} as ts_code, cast(ts as date) as trade_date, value as close, event_id * 1000.0::double as amount
from events where cast(ts as date) between date '2024-01-05' and date '2024-01-24'""",
)
def read_landed(spark, sf_dir):
    """Day folders outside the range are not read."""
    root = scratch_path(spark, "landing")
    rows = table(spark, sf_dir, "events").select(
        code(F.col("user_id")).alias("ts_code"), F.col("ts").cast("date").alias("trade_date"), F.col("value").alias("close"),
        F.col("event_id").alias("amount"),
    )
    text = _text(rows).withColumn(landed.LANDED_DAY, F.col("trade_date"))
    text.repartition(landed.LANDED_DAY).write.partitionBy(landed.LANDED_DAY).json(f"{root}/daily")
    schema = T.StructType.fromDDL("ts_code string, trade_date string, close string, amount string")
    raw = landed.read_landed(spark, root, "daily", schema, "json", date(2024, 1, 5), date(2024, 1, 24))
    return cleaning.clean(raw, SPECS["daily_raw"]).drop(landed.LANDING_ORDER)


def _land_bars(rows, root, by_day=False):
    """Bars as gzip CSV; shard P2 lands with another column order, an unnamed first column and 40 columns in all, and
    one file is empty."""
    text = rows.withColumn("trade_time", dates.compact_timestamp(F.col("trade_time")))
    text = checkpointed(cleaning.with_shard(text.select(*bars_csv.BAR_COLUMNS)))
    wide = [F.lit(i).alias(f"x{i}") for i in range(31)]
    swapped = [F.lit("7").alias(" "), "trade_time", *wide, "ts_code", "amount", "volume", "close", "low", "high", "open"]
    for rows, columns in ((text.where("shard <> 'P2'"), list(bars_csv.BAR_COLUMNS)), (text.where("shard = 'P2'"), swapped)):
        if by_day:
            day = F.substring("trade_time", 1, 8).alias(landed.LANDED_DAY)
            out = rows.select(*columns, day).repartition(landed.LANDED_DAY).write.partitionBy(landed.LANDED_DAY)
            out.mode("append").option("header", "true").option("compression", "gzip").csv(f"{root}/{bar_jobs.FEED}")
        else:
            bars_csv.write_bars_csv(rows.select(*columns), f"{root}/{bar_jobs.FEED}")
    bars_csv.write_bars_csv(text.select(*bars_csv.BAR_COLUMNS).where("false"), f"{root}/{bar_jobs.FEED}")


@check(
    "read_bars_csv",
    f"""with {SQL_BARS} select ts_code, trade_time, open, high, low, close, amount::double as amount, volume * 100.0::double as vol_share from bars""",
)
def read_bars_csv(spark, sf_dir):
    root = scratch_path(spark, "bars")
    _land_bars(bars(spark, sf_dir), root)
    raw = bars_csv.read_bars_csv(spark, f"{root}/{bar_jobs.FEED}")
    return cleaning.clean_bars(raw, BARS, bars_csv.SOURCE_FILE).drop(bars_csv.SOURCE_FILE, landed.LANDING_ORDER)


@check(
    "restrict_codes_file",
    f"""with {SQL_BARS} select ts_code, trade_time, high from bars
where ts_code in (select {sql_code('c_custkey')} from customer where c_acctbal > 0)""",
)
def restrict_codes_file(spark, sf_dir):
    """A codes file with blanks and padding restricts the bars."""
    path = scratch_path(spark, "codes")
    wanted = instruments(spark, sf_dir).where("c_acctbal > 0")
    line = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("  "), F.col("ts_code"), F.lit("\n "))).otherwise(F.col("ts_code"))
    wanted.select(line.alias("value")).write.text(path)
    return cleaning.only_codes(bars(spark, sf_dir), landed.read_codes(spark, path)).select("ts_code", "trade_time", "high")


# --- written tables -----------------------------------------------------------------------------------


@check(
    "apply_retention",
    """with o as (select o_orderkey, cast(o_orderdate as date) as trade_date, o_totalprice from orders)
select o_orderkey, trade_date, o_totalprice from o where trade_date >= date '1998-06-17'""",
)
def apply_retention(spark, sf_dir):
    """Months before the cutoff are dropped, its own month is rewritten."""
    schema = T.StructType.fromDDL("o_orderkey bigint, trade_date date, o_totalprice double")
    lake = LakeTable(spark, scratch_path(spark, "orders"), schema, ("trade_month",), ("o_orderkey",))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("trade_date"), "o_totalprice")
    rows = rows.withColumn("trade_month", dates.month_label(F.col("trade_date")))
    lake.replace(rows, [])
    jobs.apply_retention(lake, F.col("trade_date"), date(1998, 6, 17))
    return lake.rows()


@check(
    "retention_split",
    """select o_orderpriority, count(*) filter (not coalesce(day < date '1998-06-17', false)) as rows_kept,
 count(*) filter (day < date '1998-06-17') as rows_deleted
from (select o_orderpriority, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as day from orders) group by 1""",
)
def retention_counts(spark, sf_dir):
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    return retention_split(table(spark, sf_dir, "orders"), day, date(1998, 6, 17), [F.col("o_orderpriority")])


# --- jobs -----------------------------------------------------------------------------------------------


def _daily_lake(spark, sf_dir, feeds=True):
    root = scratch_path(spark, "lake")
    lake = jobs.Lake(spark, f"{root}/tables", f"{root}/landing")
    _land(calendar(spark, sf_dir), lake.landing, "trade_cal")
    if not feeds:
        return lake
    _land(daily(spark, sf_dir), lake.landing, "daily")
    _land(basic(spark, sf_dir), lake.landing, "daily_basic")
    return lake


DAILY_OUT = ["ts_code", "trade_date", "close", "amount", "pe", "vol_share"]


def _sql_daily_job(keep_from: str, until: str) -> str:
    # feeds are landed for open days only, so the extra feed's closed days are skipped as well
    return f"""with {SQL_CAL}, {SQL_MERGED},
c as (select cal_date as cutoff from open_cal where cal_date <= date '{until}' order by cal_date desc limit 1 offset 499)
select ts_code, trade_date, close, amount * 1000.0::double as amount, pe, vol * 100.0::double as vol_share from merged, c
where trade_date in (select cal_date from open_cal) and trade_date >= {keep_from} and trade_date <= date '{until}'"""


@check("update_daily", _sql_daily_job("cutoff", "2000-12-31"))
def update_daily(spark, sf_dir):
    """Two runs: the second continues after the first one's cursor and moves the retention window."""
    lake = _daily_lake(spark, sf_dir)
    jobs.update(lake, ["daily_raw"], date(2000, 6, 30), NOW)
    jobs.update(lake, ["daily_raw"], END, NOW)
    return lake.table(SPECS["daily_raw"]).rows().select(*DAILY_OUT)


@check(
    "update_report",
    f"""with {SQL_CAL}, {SQL_MERGED},
c as (select cal_date as cutoff from open_cal where cal_date <= date '2000-12-31' order by cal_date desc limit 1 offset 499),
m as (select * from merged, c where trade_date in (select cal_date from open_cal) and trade_date >= cutoff and trade_date <= date '2000-12-31'),
all_cal as (select * from cal where cal_date between date '2000-12-31' - 1825 and date '2000-12-31'),
again as (select m.*, ts_code < '000005' and (ts_code, trade_date) in (select ts_code, trade_date from daily) as revised
 from m where trade_date >= date '2000-07-01')
select 1 as run, 'daily_raw' as "table", count(*) as rows_fetched, count(*) as rows_inserted, 0 as rows_updated, 0 as rows_unchanged,
 6004 as rows_dropped, 2 as rows_not_finite, count(*) as rows_affected, 1 as pages_truncated, 0 as rows_deleted,
 strftime(max(trade_date), '%Y-%m-%d') as cursor_value, strftime(any_value(cutoff), '%Y-%m-%d') as retention_cutoff from m
union all select 1, 'trade_cal', count(*), count(*), 0, 0, 0, 0, count(*), 0, 0, strftime(max(cal_date), '%Y-%m-%d'), null from all_cal
union all select 2, 'daily_raw', count(*), 0, count(*) filter (revised), count(*) filter (not revised), 4, 2, 2 * count(*) filter (revised), 0, 0,
 (select strftime(max(trade_date), '%Y-%m-%d') from m), strftime(any_value(cutoff), '%Y-%m-%d') from again
union all select 2, 'trade_cal', count(*), 0, 0, count(*), 0, 0, 0, 0, 0, strftime(max(cal_date), '%Y-%m-%d'), null from all_cal""",
)
def update_report(spark, sf_dir):
    """Two runs over landed rows of which some lack a key or hold an infinity, and one file is a full page; the second
    finds some prices revised."""
    lake = _daily_lake(spark, sf_dir)
    bad = local_frame(
        spark,
        [(None, "20001229", "1"), ("000001.SZ", None, "1"), ("000001.SZ", "2000", "2"), (None, "20001228", "inf"), ("x.SZ", "19700101", "-Infinity")],
        "ts_code string, trade_date string, close string",
    )
    bad.limit(4).write.mode("append").json(f"{lake.landing}/daily")
    bad.where("ts_code = 'x.SZ'").write.mode("append").json(f"{lake.landing}/daily")
    page = spark.range(0, PAGE_ROWS, 1, 1).select(F.lit("20001229").alias("trade_date"), F.col("id").cast("string").alias("close"))
    page.write.mode("append").json(f"{lake.landing}/daily")
    first = jobs.report_frame(spark, jobs.update(lake, ["daily_raw"], END, NOW, count_changes=True))
    revised = daily(spark, sf_dir).where("ts_code < '000005'").withColumn("close", F.col("close") + 1)
    delete_folder(spark, f"{lake.landing}/daily")
    _land(daily(spark, sf_dir).where("ts_code >= '000005'").unionByName(revised), lake.landing, "daily")
    bad.write.mode("append").json(f"{lake.landing}/daily")
    again = jobs.update(lake, ["daily_raw"], END, NOW, start=date(2000, 7, 1), count_changes=True)
    columns = ["run", "table", "rows_fetched", "rows_inserted", "rows_updated", "rows_unchanged", "rows_dropped",
               "rows_not_finite", "rows_affected", "pages_truncated", "rows_deleted", "cursor_value", "retention_cutoff"]
    both = first.withColumn("run", F.lit(1)).unionByName(jobs.report_frame(spark, again).withColumn("run", F.lit(2)))
    return both.select(*columns)


@check("update_codes_then_full", _sql_daily_job("cutoff", "2000-12-31"))
def update_codes_then_full(spark, sf_dir):
    """A run with a few codes leaves all others for the next one."""
    lake = _daily_lake(spark, sf_dir)
    few = daily(spark, sf_dir).select("ts_code").where("ts_code < '000003'").distinct()
    jobs.update(lake, ["daily_raw"], END, NOW, codes=few)
    jobs.update(lake, ["daily_raw"], END, NOW)
    return lake.table(SPECS["daily_raw"]).rows().select(*DAILY_OUT)


@check("update_feeds_late", _sql_daily_job("cutoff", "2000-12-31"))
def update_feeds_late(spark, sf_dir):
    """The feeds of a day land in runs of their own, in either order; then one feed's files are rewritten with other prices."""
    lake = _daily_lake(spark, sf_dir, feeds=False)
    main, extra = daily(spark, sf_dir), basic(spark, sf_dir)
    early = F.col("trade_date") < F.lit(date(2000, 3, 1))
    wrong = main.withColumn("close", F.lit(-1.0)).where("abs(hash(ts_code)) % 2 = 0")
    steps = (
        [(extra.where(early), "daily_basic"), (wrong.where(~early), "daily")],
        [(extra.where(~early), "daily_basic"), (wrong.where(early), "daily")],
    )
    for step in steps:
        for rows, feed in step:
            _land(rows, lake.landing, feed)
        jobs.update(lake, ["daily_raw"], END, NOW)
    delete_folder(spark, f"{lake.landing}/daily")
    _land(main, lake.landing, "daily")
    jobs.update(lake, ["daily_raw"], END, NOW)
    return lake.table(SPECS["daily_raw"]).rows().select(*DAILY_OUT)


@check("backfill_master", _sql_daily_job("cutoff", "2000-12-31"))
def backfill_master(spark, sf_dir):
    """Month batches over the retention window, here a year of months per job."""
    lake = _daily_lake(spark, sf_dir)
    jobs.backfill_master(lake, END, NOW, 500, ["daily_raw"], months_per_batch=12)
    return lake.table(SPECS["daily_raw"]).rows().select(*DAILY_OUT)


@check(
    "update_new_columns",
    f"""with {SQL_EVENT_CAL}, f as (
  select {sql_code('user_id')} as ts_code, cast(ts as date) as trade_date, max(value) as adj_factor, count(*) as n_events,
         avg(event_id) as mean_id, min(event_type) as first_kind, max(cast(ts as date)) as seen_date
  from events where cast(ts as date) in (select cal_date from open_ecal) group by 1, 2)
select ts_code, trade_date, adj_factor, case when new then n_events end as n_events, case when new then mean_id end as mean_id,
 case when new then first_kind end as first_kind, case when new then seen_date end as seen_date
from (select *, trade_date > date '2024-01-15' as new from f)""",
)
def update_new_columns(spark, sf_dir):
    """From some day on the vendor sends four more columns, of which the table keeps the types."""
    root = scratch_path(spark, "lake")
    lake = jobs.Lake(spark, f"{root}/tables", f"{root}/landing")
    _land(event_calendar(spark, sf_dir), lake.landing, "trade_cal")
    ev = table(spark, sf_dir, "events")
    rows = ev.groupBy(code(F.col("user_id")).alias("ts_code"), F.col("ts").cast("date").alias("trade_date")).agg(
        F.max("value").alias("adj_factor"), F.count(F.lit(1)).alias("n_events"), F.avg("event_id").alias("mean_id"),
        F.min("event_type").alias("first_kind"), F.max(F.col("ts").cast("date")).alias("seen_date"),
    )
    dated = rows.withColumns({c: dates.compact_date(F.col(c)) for c in ("trade_date", "seen_date")})
    early = F.col("trade_date") <= "20240115"
    dated.where(early).select("ts_code", "trade_date", "adj_factor").write.json(f"{lake.landing}/adj_factor")
    jobs.update(lake, ["adj_factor"], date(2024, 1, 15), NOW, start=date(2024, 1, 1), no_delete=True)
    dated.where(~early).write.mode("append").json(f"{lake.landing}/adj_factor")
    jobs.update(lake, ["adj_factor"], NOW.date(), NOW, no_delete=True)
    return lake.table(SPECS["adj_factor"]).rows()


@check("quarantined_lines", "select event_id from events where event_type = 'error' or event_id % 10 = 3")
def quarantined_lines(spark, sf_dir):
    """Landed lines that were cut off, or are an array and no object."""
    root = scratch_path(spark, "lines")
    whole = F.to_json(F.struct("event_id", "user_id", "event_type"))
    line = F.when(F.col("event_type") == "error", F.substring_index(whole, ",", 2)).when(F.col("event_id") % 10 == 3, F.concat(F.lit("["), whole, F.lit("]")))
    table(spark, sf_dir, "events").select(F.coalesce(line, whole).alias("value")).write.text(f"{root}/feed")
    found = landed.quarantined(spark, root, "feed")
    return found.select(F.regexp_extract("value", r'"event_id":(\d+)', 1).cast("bigint").alias("event_id"))


def _bar_lake(spark, sf_dir, land=True):
    root = scratch_path(spark, "bars")
    lake = jobs.Lake(spark, f"{root}/tables", f"{root}/landing")
    _land(event_calendar(spark, sf_dir), lake.landing, "trade_cal")
    _land(instruments(spark, sf_dir).select("ts_code", F.col("c_name").alias("name")), lake.landing, "stock_basic")
    jobs.update(lake, ["trade_cal", "stock_basic"], NOW.date(), NOW)
    if land:
        _land_bars(bars(spark, sf_dir), lake.landing, by_day=True)
    return lake


def _sql_bar_job(keep: int, end: str, codes: str = "true") -> str:
    return f"""with {SQL_BARS}, {SQL_EVENT_CAL},
c as (select cal_date as cutoff from open_ecal where cal_date <= date '{end}' order by cal_date desc limit 1 offset {keep - 1})
select ts_code, trade_time, open, high, low, close, amount::double as amount, volume * 100.0::double as vol_share, {sql_shard('ts_code')} as shard
from bars, c where cast(trade_time as time) between time '09:30:00' and time '15:00:00'
 and cast(trade_time as date) in (select cal_date from open_ecal) and cast(trade_time as date) between cutoff and date '{end}' and {codes}"""


@check(
    "update_bars",
    _sql_bar_job(15, "2024-01-30", f"ts_code in (select {sql_code('c_custkey')} from customer where c_acctbal > 0)"),
)
def update_bars(spark, sf_dir):
    """Given codes, two runs, the second without an explicit end."""
    lake = _bar_lake(spark, sf_dir)
    wanted = instruments(spark, sf_dir).where("c_acctbal > 0")
    bar_jobs.update_bars(lake, NOW, end=date(2024, 1, 18), codes=wanted, keep_open_days=10)
    bar_jobs.update_bars(lake, datetime(2024, 1, 30, 18, 0), codes=wanted, keep_open_days=15)
    return lake.table(BARS).read().drop("trade_day")


@check(
    "backfill_bars",
    _sql_bar_job(20, "2024-01-30", f"ts_code in (select {sql_code('c_custkey')} from customer)"),
)
def backfill_bars(spark, sf_dir):
    """Every instrument; interrupted after some days, then resumed to the end."""
    lake = _bar_lake(spark, sf_dir)
    bar_jobs.backfill_bars(lake, NOW, end=date(2024, 1, 30), keep_open_days=20, resume=True, max_days=7)
    bar_jobs.backfill_bars(lake, NOW, end=date(2024, 1, 30), keep_open_days=20, resume=True)
    return lake.table(BARS).read().drop("trade_day")


@check(
    "backfill_limited_then_full",
    _sql_bar_job(20, "2024-01-30", f"ts_code in (select {sql_code('c_custkey')} from customer)"),
)
def backfill_limited_then_full(spark, sf_dir):
    """A controlled run with a few instruments, then all of them."""
    lake = _bar_lake(spark, sf_dir)
    bar_jobs.backfill_bars(lake, NOW, end=date(2024, 1, 30), keep_open_days=20, resume=True, max_codes=10)
    bar_jobs.backfill_bars(lake, NOW, end=date(2024, 1, 30), keep_open_days=20, resume=True)
    return lake.table(BARS).read().drop("trade_day")


@check(
    "backfill_bars_late_files",
    _sql_bar_job(20, "2024-01-30", f"ts_code in (select {sql_code('c_custkey')} from customer)"),
)
def backfill_bars_late_files(spark, sf_dir):
    """Half of each day lands with wrong prices and is loaded; then its files are rewritten and the rest lands."""
    lake = _bar_lake(spark, sf_dir, land=False)
    wrong = bars(spark, sf_dir).withColumn("close", F.lit(-1.0)).where("abs(hash(ts_code)) % 2 = 0")
    _land_bars(wrong, lake.landing, by_day=True)
    bar_jobs.backfill_bars(lake, NOW, end=date(2024, 1, 30), keep_open_days=20, resume=True, write_mode="upsert")
    delete_folder(spark, bar_jobs.landed_path(lake))
    _land_bars(bars(spark, sf_dir), lake.landing, by_day=True)
    bar_jobs.backfill_bars(lake, NOW, end=date(2024, 1, 30), keep_open_days=20, resume=True, write_mode="upsert")
    return lake.table(BARS).read().drop("trade_day")


# --- streams ----------------------------------------------------------------------------------------------


def _stream_files(spark, sf_dir, root, copies):
    """Events as files in arrival order; every row is delivered ``copies`` times, the last one revised."""
    ev = table(spark, sf_dir, "events").select(
        code(F.col("user_id")).alias("ts_code"), F.col("ts").alias("trade_time"), "event_id", "value"
    )
    for i in range(copies):
        rows = ev.withColumn("value", F.col("value") + (copies - 1 - i)).withColumn("delivery", F.lit(i))
        rows.repartition(4).write.mode("append").parquet(root)
    return "ts_code string, trade_time timestamp_ntz, event_id bigint, value double, delivery int"


@check(
    "stream_ingest",
    f"""select {sql_code('user_id')} as ts_code, cast(ts as date) as trade_date, count(distinct event_id) as n,
 max(event_id) as last_event from events where cast(ts as date) <= date '2024-01-25' group by 1, 2""",
)
def stream_ingest(spark, sf_dir):
    """Files delivered twice merge to one row per key; days after the last finished session are held, and a second
    run, for which nothing new lands, releases those finished by then."""
    from ..plans.specs import TableSpec

    root = scratch_path(spark, "stream")
    ddl = _stream_files(spark, sf_dir, f"{root}/in", 2)
    spec = TableSpec(
        "ticks", ("ts_code", "event_id", "trade_date"), "ts_code string, event_id bigint, trade_date date, value double",
        cursor="trade_date", keep_open_days=1, partition_by=("trade_month",),
    )
    target = LakeTable(spark, f"{root}/ticks", spec.schema, spec.partition_by, spec.keys)
    held_schema = "ts_code string, event_id bigint, trade_date date, value double, landing_order int"
    held = streaming.held_table(spark, f"{root}/held", held_schema)
    for finished in (date(2024, 1, 18), date(2024, 1, 25)):
        stream = streaming.landed_stream(spark, f"{root}/in", T.StructType.fromDDL(ddl), files_per_batch=4)
        query = streaming.ingest(
            stream, target, spec, f"{root}/checkpoint", order="delivery",
            post=lambda df: df.select("ts_code", "event_id", F.col("trade_time").cast("date").alias("trade_date"), "value", "delivery"),
            done_day=lambda: finished, day=F.col("trade_date"), held=held,
        )
        query.awaitTermination()
    return target.rows().groupBy("ts_code", "trade_date").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event")
    )


@check("stream_dedupe", f"select event_id, {sql_code('user_id')} as ts_code, ts as trade_time from events")
def stream_dedupe(spark, sf_dir):
    """Insert-only feed delivered twice: each key once."""
    root = scratch_path(spark, "dedupe")
    ddl = _stream_files(spark, sf_dir, f"{root}/in", 2)
    stream = streaming.landed_stream(spark, f"{root}/in", T.StructType.fromDDL(ddl))
    # event time must be a zoned timestamp for watermarks
    timed = stream.withColumn("seen_at", F.col("trade_time").cast("timestamp"))
    once = streaming.distinct_stream(timed, ["event_id"], "seen_at", "60 days").select("event_id", "ts_code", "trade_time")
    query = (
        once.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{root}/out")
