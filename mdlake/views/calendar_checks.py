"""Calendar operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import calendar as cal_ops
from .base import SQL_CAL, SQL_EVENT_CAL, calendar, check, code, event_calendar, sql_code, table

END = date(2000, 12, 31)


@check("open_days", f"with {SQL_CAL} select cal_date from open_cal where cal_date between date '1996-01-01' and date '2000-12-31'")
def open_days(spark, sf_dir):
    return cal_ops.open_days(calendar(spark, sf_dir), start=date(1996, 1, 1), end=END)


@check(
    "cutoff_last_n",
    f"""with {SQL_CAL}, keeps as (select unnest([250, 500, 2000]) as keep_open_days),
ranked as (select cal_date, row_number() over (order by cal_date) as pos from open_cal),
ends as (select cal_date as end_date, (select count(*) from open_cal o where o.cal_date <= cal.cal_date) as n from cal)
select end_date, keep_open_days, r.cal_date as cutoff
from ends join keeps on true left join ranked r on r.pos = n - keep_open_days + 1""",
)
def cutoff_last_n(spark, sf_dir):
    cal = calendar(spark, sf_dir)
    return cal_ops.cutoffs(cal, cal.select(F.col("cal_date").alias("end_date")), [250, 500, 2000])


@check(
    "prev_open_day",
    f"""with {SQL_CAL}, p as (select exchange, cal_date, cal_date - 1 as pretrade_date,
 (select max(o.cal_date) from open_cal o where o.cal_date < cal.cal_date) as prev_open from cal where is_open = 1)
select *, prev_open is not distinct from pretrade_date as agrees from p""",
)
def prev_open_day(spark, sf_dir):
    cal = calendar(spark, sf_dir).withColumn("pretrade_date", F.date_sub("cal_date", 1))
    return cal_ops.previous_open_days(cal)


@check(
    "latest_open_day",
    f"""with {SQL_CAL} select max(cal_date) as latest_open, strftime(max(cal_date), '%Y%m%d') as latest_open_text
from open_cal where cal_date <= date '1998-08-02'""",
)
def latest_open_day(spark, sf_dir):
    return cal_ops.latest_open_day(calendar(spark, sf_dir), date(1998, 8, 2))


@check(
    "last_completed_day",
    f"""with {SQL_EVENT_CAL}, req as (
  select event_id, ts, event_type = 'purchase' as explicit, cast(ts as date) - (user_id % 2)::int as end_day from events)
select event_id, case when explicit or end_day <> cast(ts as date) or cast(ts as time) >= time '15:05:00' then end_day
  else coalesce((select max(cal_date) from open_ecal o where o.cal_date < end_day and o.cal_date >= end_day - 10), end_day - 1)
  end as done_day from req""",
)
def last_completed_day(spark, sf_dir):
    requests = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        (F.col("event_type") == "purchase").alias("explicit"),
        F.date_sub(F.col("ts").cast("date"), (F.col("user_id") % 2).cast("int")).alias("end_day"),
    )
    done = cal_ops.last_completed_day(
        requests, event_calendar(spark, sf_dir), F.col("end_day"), F.col("ts"), F.col("explicit")
    )
    return done.select("event_id", "done_day")


@check(
    "calendar_depth",
    f"""with {SQL_CAL}, needs as (select {sql_code('l_suppkey')} as table_name, count(*) as keep_open_days from lineitem group by 1),
have as (select count(*) as open_days from open_cal where cal_date <= date '2000-12-31')
select table_name, keep_open_days, greatest(5, keep_open_days // 200 + 2)::int as years,
  date '2000-12-31' - (greatest(5, keep_open_days // 200 + 2) * 365)::int as load_from, open_days,
  open_days >= keep_open_days as enough from needs, have""",
)
def calendar_depth(spark, sf_dir):
    needs = table(spark, sf_dir, "lineitem").groupBy(code(F.col("l_suppkey")).alias("table_name")).agg(
        F.count(F.lit(1)).alias("keep_open_days")
    )
    return cal_ops.calendar_depth(calendar(spark, sf_dir), needs, END)


@check(
    "open_day_semi",
    f"""with {SQL_CAL} select l_orderkey, l_linenumber, l_suppkey, l_shipdate from lineitem
where cast(l_shipdate as date) in (select cal_date from open_cal)""",
)
def open_day_semi(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return cal_ops.on_open_days(facts, calendar(spark, sf_dir), F.col("l_shipdate").cast("date"))
