"""Work windows, start dates, cursors and resumable units."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import codes
from ..operators import calendar as cal_ops, cleaning, quality, ranking, state, windows
from .base import (
    SQL_BARS,
    SQL_CAL,
    bars,
    calendar,
    check,
    code,
    instruments,
    sql_code,
    sql_shard,
    table,
)

SQL_SPANS = """spans as (select o_custkey, min(cast(o_orderdate as date)) as s, max(cast(o_orderdate as date)) as e
 from orders group by 1)"""


def _spans(spark, sf_dir, by="o_custkey"):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").groupBy(by).agg(F.min(day).alias("s"), F.max(day).alias("e"))


@check(
    "windows_fixed",
    f"""with {SQL_SPANS} select o_custkey, (s + 91 * i::int) as window_start, least(s + 91 * i::int + 90, e) as window_end
from spans, lateral (select unnest(range(0, (e - s) // 91 + 1)) as i)""",
)
def windows_fixed(spark, sf_dir):
    return windows.fixed_windows(_spans(spark, sf_dir), F.col("s"), F.col("e")).drop("s", "e")


@check(
    "windows_month",
    f"""with {SQL_SPANS}, m as (
 select o_custkey, s, e, cast(unnest(generate_series(date_trunc('month', s)::timestamp, e::timestamp, interval 1 month)) as date) as f from spans)
select o_custkey, 'floor' as variant, f as window_start, least(last_day(f), e) as window_end from m
union all select o_custkey, 'clamp', greatest(f, s), least(last_day(f), e) from m""",
)
def windows_month(spark, sf_dir):
    spans = _spans(spark, sf_dir)
    variants = [
        windows.month_windows(spans, F.col("s"), F.col("e"), clamp).withColumn("variant", F.lit(label))
        for label, clamp in (("floor", False), ("clamp", True))
    ]
    return variants[0].union(variants[1]).drop("s", "e")


@check(
    "windows_daily",
    """with spans as (select o_orderpriority, min(cast(o_orderdate as date)) as s, max(cast(o_orderdate as date)) as e from orders group by 1)
select o_orderpriority, s + i::int as window_start, s + i::int as window_end from spans, lateral (select unnest(range(0, e - s + 1)) as i)""",
)
def windows_daily(spark, sf_dir):
    return windows.fixed_windows(_spans(spark, sf_dir, "o_orderpriority"), F.col("s"), F.col("e"), span_days=0).drop("s", "e")


BISECT_CAP = 60


@check(
    "bisect_windows",
    f"""with recursive per_day as (
 select l_linestatus, cast(l_shipdate as date) as day, count(*) as n from lineitem group by 1, 2),
w as (
 select distinct l_linestatus, cast(date_trunc('month', day) as date) as a, last_day(day) as b, true as again from per_day
 union all
 select l_linestatus, x.a, x.b, x.a < x.b from (
   select l_linestatus, a, b, a + ((b - a) // 2)::int as mid from w
   where again and a < b and (select sum(n) from per_day p where p.l_linestatus = w.l_linestatus and p.day between w.a and w.b) >= {BISECT_CAP}),
   lateral (values (a, mid), (mid + 1, b)) as x(a, b)),
c as (select l_linestatus, a, b, coalesce((select sum(n) from per_day p where p.l_linestatus = w.l_linestatus and p.day between w.a and w.b), 0)::bigint as n from w)
select l_linestatus, a as window_start, b as window_end, n as n_rows, n >= {BISECT_CAP} as over_cap
from c where n < {BISECT_CAP} or a = b""",
)
def bisect_windows(spark, sf_dir):
    per_day = table(spark, sf_dir, "lineitem").groupBy("l_linestatus", F.col("l_shipdate").cast("date").alias("day"))
    return windows.bisect_windows(per_day.agg(F.count(F.lit(1)).alias("n")), ["l_linestatus"], BISECT_CAP)


@check(
    "work_units",
    f"""with {SQL_CAL} select distinct {sql_code('l_suppkey')} as ts_code, cast(l_shipdate as date) as day, t as limit_type
from lineitem, (values ('U'), ('D'), ('Z')) as types(t) where cast(l_shipdate as date) in (select cal_date from open_cal)""",
)
def work_units(spark, sf_dir):
    units = table(spark, sf_dir, "lineitem").select(code(F.col("l_suppkey")).alias("ts_code"), F.col("l_shipdate").cast("date").alias("day"))
    return windows.per_limit_type(cal_ops.on_open_days(units.distinct(), calendar(spark, sf_dir), F.col("day")))


PLAN_END = date(2000, 12, 31)
SQL_CURSORS = """cursors as (
 select l_suppkey, max(case when l_shipdate < timestamp '2000-06-01' and l_suppkey % 4 <> 0 then cast(l_shipdate as date) end) as cur,
  case l_suppkey % 3 when 0 then 250 when 1 then 500 end as keep, case when l_suppkey % 7 = 0 then date '1997-05-05' end as req,
  (case when l_suppkey % 5 = 0 then 30 else 0 end) as lookback
 from lineitem group by l_suppkey)"""


def _cursors(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    known = F.expr("case when l_shipdate < timestamp_ntz '2000-06-01' and l_suppkey % 4 <> 0 then cast(l_shipdate as date) end")
    return li.groupBy("l_suppkey").agg(F.max(known).alias("cur")).select(
        "*",
        F.expr("case l_suppkey % 3 when 0 then 250 when 1 then 500 end").alias("keep_open_days"),
        F.expr("case when l_suppkey % 7 = 0 then date '1997-05-05' end").alias("req"),
        F.expr("case when l_suppkey % 5 = 0 then 30 else 0 end").alias("lookback"),
    )


@check(
    "plan_start",
    f"""with {SQL_CAL}, {SQL_CURSORS}, ranked as (
 select cal_date, row_number() over (order by cal_date desc) as rn from open_cal where cal_date <= date '2000-12-31'),
p as (select l_suppkey, lookback, r.cal_date as cutoff, coalesce(req, cur + 1, r.cal_date, date '2000-12-31' - 7300) as s
 from cursors left join ranked r on r.rn = keep),
q as (select *, greatest(s, cutoff) as g from p)
select l_suppkey, cutoff, greatest(case when lookback > 0 then least(g, date '2000-12-31' - 2 * lookback) else g end, cutoff) as start_day from q""",
)
def plan_start(spark, sf_dir):
    cal = calendar(spark, sf_dir)
    ends = cal.where(F.col("cal_date") <= F.lit(PLAN_END)).agg(F.max("cal_date").alias("end_date"))
    limits = F.broadcast(cal_ops.cutoffs(cal, ends, [250, 500]).drop("end_date"))  # one row per retention length
    planned = _cursors(spark, sf_dir).join(limits, "keep_open_days", "left")
    start = state.plan_start(F.col("req"), F.col("cur"), F.col("cutoff"), F.lit(PLAN_END), F.col("lookback"))
    return planned.select("l_suppkey", "cutoff", start.alias("start_day"))


CHUNK = 400


@check(
    "chunk_codes",
    f"""with c as (select distinct {sql_code('o_custkey')} as ts_code from orders),
n as (select ts_code, {sql_shard('ts_code')} as shard, row_number() over (partition by {sql_shard('ts_code')} order by ts_code) - 1 as pos from c)
select ts_code, shard, pos, pos // {CHUNK} + 1 as chunk, (count(*) over (partition by shard) + {CHUNK - 1}) // {CHUNK} as n_chunks from n""",
)
def chunk_codes(spark, sf_dir):
    listed = table(spark, sf_dir, "orders").select(code(F.col("o_custkey")).alias("ts_code")).distinct()
    return ranking.chunk_codes(cleaning.with_shard(listed), CHUNK)


@check("sample_codes", f"select {sql_code('c_custkey')} as ts_code from customer order by md5({sql_code('c_custkey')}) limit 100")
def sample_codes(spark, sf_dir):
    return ranking.sample_codes(instruments(spark, sf_dir).select("ts_code"), 100)


@check(
    "max_cursor",
    f"select {sql_code('l_suppkey')} as ts_code, max(cast(l_shipdate as date)) as cursor_day, count(*) as n_rows from lineitem group by 1",
)
def max_cursor(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(code(F.col("l_suppkey")).alias("ts_code")).agg(
        F.max(F.col("l_shipdate").cast("date")).alias("cursor_day"), F.count(F.lit(1)).alias("n_rows")
    )


@check("max_day", "select cast(max(ts) as date) as max_day from events")
def max_day(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.max("ts").cast("date").alias("max_day"))


@check(
    "advance_cursor",
    """with progress as (
 select l_suppkey, max(case when l_suppkey % 4 <> 0 and l_shipdate < timestamp '2000-01-01' then cast(l_shipdate as date) end) as cur,
  max(case when l_suppkey % 5 <> 0 and l_suppkey % 3 <> 0 then cast(l_shipdate as date) - 800 end) as newest,
  count(*) filter (l_suppkey % 5 <> 0) as n from lineitem group by 1)
select l_suppkey, case when v is null then cur when cur is null then v else greatest(v, cur) end as next_cursor from (
 select l_suppkey, cur, case when newest is not null then newest when n > 0 then date '2000-12-31' else cur end as v from progress)
where v is not null or cur is not null""",
)
def advance_cursor(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    fed = F.col("l_suppkey") % 5 != 0
    before = (F.col("l_suppkey") % 4 != 0) & (day < F.lit("2000-01-01").cast("date"))
    progress = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.max(F.when(before, day)).alias("cur"),
        F.max(F.when(fed & (F.col("l_suppkey") % 3 != 0), F.date_sub(day, 800))).alias("newest"),
        F.count_if(fed).alias("n"),
    )
    following = state.advance_cursor(F.col("cur"), F.col("newest"), F.col("n"), F.lit(PLAN_END))
    return progress.select("l_suppkey", following.alias("next_cursor")).where("next_cursor is not null")


@check(
    "state_upsert",
    f"""with s as (select 'MASTER' as cluster, {sql_code('l_orderkey')} as table_name, l_shipdate, cast(l_shipdate as date) as d from lineitem),
old as (select cluster, table_name, max(d) as v, max(l_shipdate) as stamp from s where d < date '1999-01-01' group by 1, 2),
new as (select cluster, table_name, max(d) as v, max(l_shipdate) as stamp from s where d >= date '1999-01-01' group by 1, 2)
select cluster, table_name, 'trade_date' as cursor_col, strftime(v, '%Y-%m-%d') as cursor_value, stamp as updated_at from new
union all select cluster, table_name, 'trade_date', strftime(v, '%Y-%m-%d'), stamp from old
where table_name not in (select table_name from new)""",
)
def state_upsert(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    li = table(spark, sf_dir, "lineitem")

    def cursors(rows):
        return rows.groupBy(code(F.col("l_orderkey")).alias("table_name")).agg(
            F.max(day).cast("string").alias("cursor_value"), F.max("l_shipdate").alias("updated_at")
        ).select(F.lit("MASTER").alias("cluster"), "table_name", F.lit("trade_date").alias("cursor_col"), "cursor_value", "updated_at")

    split = F.lit("1999-01-01").cast("date")
    old = cursors(li.where(day < split))
    # a batch may carry several cursors of one table; the latest update wins
    new = cursors(li.where(day >= split))
    again = new.withColumn("cursor_value", F.lit("1990-01-01")).withColumn("updated_at", F.lit("1990-01-01").cast("timestamp_ntz"))
    return state.state_upsert(old, again.union(new))


SQL_UNITS = f"""units as (select distinct cast(trade_time as date) as day, {sql_shard('ts_code')} as shard, ts_code from bars)"""


def _units(spark, sf_dir):
    return cleaning.with_shard(bars(spark, sf_dir).select(F.col("trade_time").cast("date").alias("day"), "ts_code").distinct())


@check(
    "pending_units",
    f"""with {SQL_BARS}, {SQL_UNITS} select day, shard, ts_code from units
where not (day < date '2024-01-16' or (day = date '2024-01-16' and shard = 'P1'))""",
)
def pending_units(spark, sf_dir):
    units = _units(spark, sf_dir)
    done = units.where("day < date '2024-01-16' or (day = date '2024-01-16' and shard = 'P1')")
    return state.pending_units(units, done, ["day", "shard", "ts_code"])


SQL_COMPLETE = f"""{SQL_UNITS},
expected as (select shard, (0.6::double * count(distinct ts_code)) as expected from units group by 1),
complete as (select u.shard, day, count(distinct ts_code) as n_codes, any_value(expected) as expected
 from units u join expected e on u.shard = e.shard group by 1, 2)"""


def _complete(spark, sf_dir):
    units = _units(spark, sf_dir)
    expected = units.groupBy("shard").agg((F.lit(0.6) * F.count_distinct("ts_code")).alias("expected"))
    per_day = units.groupBy("shard", "day").agg(F.count_distinct("ts_code").alias("n_codes"))
    return per_day.join(F.broadcast(expected), "shard").withColumn("complete", F.col("n_codes") >= F.col("expected"))


@check(
    "fast_forward",
    f"""with {SQL_BARS}, {SQL_COMPLETE}, m as (
 select shard, max(day) filter (n_codes >= expected) as newest from complete group by 1)
select shard, newest, case when newest between date '2024-01-05' and date '2024-01-31' and newest > cur then newest else cur end as new_cursor
from (select *, date '2024-01-10' as cur from m)""",
)
def fast_forward(spark, sf_dir):
    newest = _complete(spark, sf_dir).groupBy("shard").agg(F.max(F.when(F.col("complete"), F.col("day"))).alias("newest"))
    day = lambda text: F.lit(text).cast("date")
    moved = state.fast_forward(day("2024-01-10"), F.col("newest"), day("2024-01-05"), day("2024-01-31"))
    return newest.withColumn("new_cursor", moved)


@check(
    "resume_chunks",
    f"""with {SQL_BARS}, {SQL_UNITS}, n as (
 select *, row_number() over (partition by shard, day order by ts_code) - 1 as pos from units)
select day, shard, ts_code, pos from n where not (day = date '2024-01-10' and pos < 20)""",
)
def resume_chunks(spark, sf_dir):
    # the within-day position restarts every day and shard
    keyed = _units(spark, sf_dir).withColumn("part", F.concat_ws("/", "shard", F.col("day").cast("string")))
    numbered = ranking.positions(keyed, "part", "ts_code").drop("part")
    marker = F.lit("2024-01-10@20")
    marked = numbered.withColumn("m_day", codes.progress_day(marker)).withColumn("m_pos", codes.progress_position(marker))
    return ranking.resume_after(marked, "day", "m_day", "m_pos").drop("m_day", "m_pos")


@check(
    "day_completeness",
    f"""with {SQL_BARS}, x as (select (0.5::double * count(distinct ts_code)) as expected from bars)
select cast(trade_time as date) as day, count(distinct ts_code) as n_codes, any_value(expected) as expected,
 count(distinct ts_code) >= any_value(expected) as complete from bars, x group by 1""",
)
def day_completeness(spark, sf_dir):
    all_bars = bars(spark, sf_dir)
    expected = all_bars.agg((F.lit(0.5) * F.count_distinct("ts_code")).alias("expected")).scalar()
    return quality.day_completeness(all_bars, F.col("trade_time").cast("date"), "ts_code", expected)


@check(
    "availability",
    f"""with {SQL_BARS} select ts_code, min(cast(trade_time as date)) as first_day, max(cast(trade_time as date)) as last_day,
 count(*) as n_bars from bars group by 1""",
)
def availability(spark, sf_dir):
    return quality.availability(bars(spark, sf_dir), F.col("trade_time").cast("date"), "ts_code")
