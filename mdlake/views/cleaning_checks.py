"""Column cleaning: the raw text is rendered from whole tables, in variants chosen by key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F, types as T

from ..functions import codes, dates, numbers
from ..operators import cleaning, state
from ..plans.specs import BARS, SPECS
from ..sources import landed
from .base import (
    SQL_BARS,
    SQL_CAL,
    SQL_FEEDS,
    bars,
    basic,
    calendar,
    check,
    code,
    daily,
    instruments,
    sql_code,
    sql_shard,
    table,
)

# Expressions below are valid in both engines, so that both start from the same raw text.
ORDER_DAY = "replace(cast(cast(o_orderdate as date) as varchar(10)), '-', '')"
SHIP_DAY = "replace(cast(cast(l_shipdate as date) as varchar(10)), '-', '')"

RAW_DATE = f"""case o_orderkey % 12
 when 0 then {ORDER_DAY} when 1 then concat({ORDER_DAY}, '.0') when 2 then cast(cast(o_orderdate as date) as varchar(10))
 when 3 then concat(' ', {ORDER_DAY}) when 4 then substring({ORDER_DAY}, 2, 7) when 5 then concat({ORDER_DAY}, '1')
 when 6 then '99991231' when 7 then cast(null as varchar(10)) when 8 then concat(substring({ORDER_DAY}, 1, 6), '00')
 when 9 then concat(substring({ORDER_DAY}, 1, 6), ' ', substring({ORDER_DAY}, 8, 1)) when 10 then 'nan'
 else concat(substring({ORDER_DAY}, 1, 4), '0230') end"""


def _duck_date(raw: str) -> str:
    text = f"regexp_replace({raw}, '\\.0$', '')"
    padded = f"(case when length({text}) < 8 then lpad({text}, 8, '0') else {text} end)"
    parsed = f"cast(try_strptime(replace({padded}, ' ', '0'), '%Y%m%d') as date)"
    shaped = f"regexp_full_match({padded}, '[0-9]{{6}}([0-9][0-9]| [1-9])')"
    return f"(case when {shaped} and {parsed} between date '1677-09-22' and date '2262-04-11' then {parsed} end)"


@check("normalize_date", f"select o_orderkey, {_duck_date('raw')} as day from (select o_orderkey, {RAW_DATE} as raw from orders)")
def normalize_date(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(RAW_DATE).alias("day"))
    return cleaning.normalize_dates(raw, ["day", "not_there"])


# Days divisible by five are batches in which no row has the 14-digit form.
TS_TEXT = "cast(ts as varchar(30))"
TS_DIGITS = f"replace(replace(replace(substring({TS_TEXT}, 1, 19), '-', ''), ':', ''), ' ', '')"
RAW_TS = f"""case when extract(day from ts) % 5 = 0 then
   case event_id % 4 when 0 then {TS_TEXT} when 1 then substring({TS_DIGITS}, 1, 12) when 2 then 'bad'
        else replace(substring({TS_TEXT}, 1, 19), '-', '/') end
 else case event_id % 6 when 0 then {TS_DIGITS} when 1 then concat({TS_DIGITS}, '.000')
        when 2 then concat(substring({TS_DIGITS}, 1, 8), ' ', substring({TS_DIGITS}, 9, 6))
        when 3 then substring({TS_TEXT}, 1, 19) when 4 then concat(substring({TS_DIGITS}, 1, 10), '6100')
        else cast(null as varchar(10)) end end"""


@check(
    "normalize_ts",
    f"""select event_id, cast(ts as date) as batch,
 case when extract(day from ts) % 5 = 0 then
   case event_id % 4 when 0 then ts when 1 then date_trunc('minute', ts) when 2 then null else date_trunc('second', ts) end
 else case event_id % 6 when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts)
   when 2 then date_trunc('second', ts) else null end end as trade_time from events""",
)
def normalize_ts(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("date").alias("batch"), F.expr(RAW_TS).alias("trade_time")
    )
    return cleaning.normalize_timestamps(raw, "trade_time", "batch").select("event_id", "batch", "trade_time")


CENTS = "cast(cast(round(o_totalprice * 100) as bigint) as varchar(20))"
RAW_NUMBER = f"""case o_orderkey % 14
 when 0 then {CENTS} when 1 then concat(' ', {CENTS}, ' ') when 2 then concat('+', {CENTS}) when 3 then concat({CENTS}, 'e1')
 when 4 then concat({CENTS}, 'd') when 5 then concat('1,', {CENTS}) when 6 then 'nan' when 7 then '-inf' when 8 then ''
 when 9 then concat('0x', {CENTS}) when 10 then concat('.', {CENTS}) when 11 then concat('-', {CENTS}, '.')
 when 12 then cast(null as varchar(10)) else concat({CENTS}, '.005') end"""
DUCK_NUMBER = r"'\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*'"


def _duck_number(raw: str, to: str = "double") -> str:
    return f"(case when regexp_full_match({raw}, {DUCK_NUMBER}) then try_cast(ltrim(trim({raw}), '+') as {to}) end)"


@check("to_numeric", f"select o_orderkey, {_duck_number('raw')} as value from (select o_orderkey, {RAW_NUMBER} as raw from orders)")
def to_numeric(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(RAW_NUMBER).alias("raw"))
    return raw.select("o_orderkey", numbers.to_number(F.col("raw")).alias("value"))


@check("nan_to_null", "select event_id, case when user_id % 5 <> 0 then value end as value from events")
def nan_to_null(spark, sf_dir):
    nan = F.when(F.col("user_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return cleaning.nan_to_null(table(spark, sf_dir, "events").select("event_id", nan.alias("value")))


RAW_ANY = f"""case o_orderkey % 5 when 0 then {ORDER_DAY} when 1 then cast(cast(o_orderdate as date) as varchar(10))
 when 2 then concat(' ', {ORDER_DAY}, ' ') when 3 then '1999-02-30' else 'today' end"""


@check(
    "parse_date_any",
    """select o_orderkey, case when o_orderkey % 5 < 3 then cast(o_orderdate as date) end as day,
 case when o_orderkey % 5 < 3 then strftime(o_orderdate, '%Y%m%d') end as day_text from orders""",
)
def parse_date_any(spark, sf_dir):
    day = dates.parse_date_any(F.expr(RAW_ANY))
    return table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"), dates.compact_date(day).alias("day_text"))


@check(
    "session_bounds",
    """select event_id, cast(ts as date) + time '09:30:00' as session_open, cast(ts as date) + time '15:00:00' as session_close,
 strftime(cast(ts as date) + time '09:30:00', '%Y%m%d%H%M%S') as open_text from events""",
)
def session_bounds(spark, sf_dir):
    day = F.col("ts").cast("date")
    opened = dates.session_bound(day, dates.SESSION_OPEN)
    return table(spark, sf_dir, "events").select(
        "event_id",
        opened.alias("session_open"),
        dates.session_bound(day, dates.SESSION_CLOSE).alias("session_close"),
        dates.compact_timestamp(opened).alias("open_text"),
    )


@check(
    "session_filter",
    f"""with {SQL_BARS} select ts_code, trade_time, high from bars
where cast(trade_time as time) between time '09:30:00' and time '15:00:00'""",
)
def session_filter(spark, sf_dir):
    return bars(spark, sf_dir).where(dates.in_session(F.col("trade_time"))).select("ts_code", "trade_time", "high")


RAW_CODE = "case c_custkey % 4 when 0 then {c} when 1 then lower({c}) when 2 then concat('  ', {c}, ' ') else c_name end"


@check(
    "code_predicate",
    f"""select c_custkey, regexp_matches(upper(trim({RAW_CODE.format(c=sql_code('c_custkey'))})), '[.](SH|SZ|BJ)$') as is_code
from customer""",
)
def code_predicate(spark, sf_dir):
    raw = instruments(spark, sf_dir).withColumn("raw", F.expr(RAW_CODE.format(c="ts_code")))
    return raw.select("c_custkey", codes.is_code(F.col("raw")).alias("is_code"))


@check(
    "shard_route",
    f"""select ts_code, {sql_shard('ts_code')} as shard, (('0x' || substr(md5(ts_code), 1, 8))::bigint % 3)::int as shard_no
from (select {sql_code('c_custkey')} as ts_code from customer)""",
)
def shard_route(spark, sf_dir):
    named = cleaning.with_shard(instruments(spark, sf_dir).select("ts_code"))
    return named.withColumn("shard_no", codes.shard_number(F.col("ts_code")))


MARKER = "case when user_id % 4 = 3 then concat('x@', {n}) when user_id % 4 = 2 then {d} else concat({d}, '@', {n}) end".format(
    d="cast(cast(ts as date) as varchar(10))", n="cast(event_id % 997 - 3 as varchar(10))"
)


@check(
    "progress_marker",
    """select event_id, case when user_id % 4 < 2 then cast(ts as date) end as resume_day,
 case when user_id % 4 < 2 then greatest(event_id % 997 - 3, 0)::int else 0 end as resume_pos from events""",
)
def progress_marker(spark, sf_dir):
    stored = table(spark, sf_dir, "events").select("event_id", F.expr(MARKER).alias("cursor_value"))
    return state.resume_point(stored).drop("cursor_value")


@check(
    "universe",
    f"""select distinct trim(raw) as ts_code from (
 select case c_custkey % 6 when 0 then null when 1 then '' when 2 then '  ' when 3 then ' ' || c else c end as raw
 from (select c_custkey, {sql_code('c_nationkey')} as c from customer)
 union all select {sql_code('c_custkey')} from customer) where trim(raw) <> ''""",
)
def universe(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", code(F.col("c_nationkey")).alias("c"))
    messy = F.expr("case c_custkey % 6 when 0 then null when 1 then '' when 2 then '  ' when 3 then concat(' ', c) else c end")
    listed = c.select(messy.alias("ts_code")).union(instruments(spark, sf_dir).select("ts_code"))
    return cleaning.universe(listed)


@check(
    "restrict_codes",
    f"""with {SQL_FEEDS} select ts_code, trade_date, close from daily where ts_code in
 (select {sql_code('c_custkey')} from customer where c_mktsegment = 'BUILDING')""",
)
def restrict_codes(spark, sf_dir):
    wanted = instruments(spark, sf_dir).where("c_mktsegment = 'BUILDING'")
    return cleaning.only_codes(daily(spark, sf_dir), wanted).select("ts_code", "trade_date", "close")


@check(
    "filter_pushdown",
    """select l_orderkey, l_linenumber, l_quantity from lineitem
where l_returnflag in ('A', 'R') and l_shipdate between timestamp '1996-01-01' and timestamp '1998-12-31'""",
)
def filter_pushdown(spark, sf_dir):
    """Accepted values and a date range reach the scan of a landed columnar feed."""
    in_range = F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-12-31").cast("timestamp_ntz"))
    schema = T.StructType.fromDDL("l_orderkey bigint, l_linenumber bigint, l_quantity double")
    rows = landed.read_landed(
        spark, sf_dir, "lineitem.parquet", schema, "parquet", where=lambda df: df.where(F.col("l_returnflag").isin("A", "R") & in_range)
    )
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


RAW_OPEN = "case when day(cal_date) % 7 = 0 then 'x' when day(cal_date) % 7 = 1 then cast(null as varchar(3)) when day(cal_date) % 7 = 2 then '1.5' else cast(is_open as varchar(3)) end"


@check(
    "post_trade_cal",
    f"""with {SQL_CAL} select exchange, cal_date, (case when day(cal_date) % 7 < 2 then 0 when day(cal_date) % 7 = 2 then 1
 else is_open end)::bigint as is_open from cal""",
)
def post_trade_cal(spark, sf_dir):
    cal = calendar(spark, sf_dir).withColumn("is_open", F.expr(RAW_OPEN))
    return cleaning.clean(cal.withColumn("cal_date", dates.compact_date(F.col("cal_date"))), SPECS["trade_cal"])


def _line_feed(spark, sf_dir):
    """Line items landed as text, one row each."""
    return table(spark, sf_dir, "lineitem").select(
        code(F.col("l_suppkey")).alias("ts_code"),
        F.expr(SHIP_DAY).alias("trade_date"),
        F.col("l_extendedprice").alias("close"),
        F.expr("cast(cast(l_quantity as int) as varchar(9))").alias("vol"),
        F.expr("case when l_linenumber = 7 then 'n/a' else cast(l_linenumber as varchar(9)) end").alias("amount"),
    )


@check(
    "post_daily_raw",
    f"""select {sql_code('l_suppkey')} as ts_code, cast(l_shipdate as date) as trade_date, l_extendedprice as close,
 case when l_linenumber <> 7 then l_linenumber * 1000.0::double end as amount, cast(l_quantity as int) * 100.0::double as vol_share
from lineitem""",
)
def post_daily_raw(spark, sf_dir):
    return cleaning.clean(_line_feed(spark, sf_dir), SPECS["daily_raw"])


@check(
    "post_index_daily",
    f"""select {sql_code('l_suppkey')} as ts_code, cast(l_shipdate as date) as trade_date, l_extendedprice as close,
 case when l_linenumber <> 7 then l_linenumber::double end as amount, cast(l_quantity as int) * 100.0::double as vol_share
from lineitem""",
)
def post_index_daily(spark, sf_dir):
    return cleaning.clean(_line_feed(spark, sf_dir), SPECS["index_daily"])


@check(
    "post_bars",
    f"""with {SQL_BARS} select ts_code, trade_time, open, high, low, close, amount::double as amount,
 volume * 100.0::double as vol_share from bars""",
)
def post_bars(spark, sf_dir):
    raw = bars(spark, sf_dir).withColumn("trade_time", F.concat(dates.compact_timestamp(F.col("trade_time")), F.lit(".000")))
    batch = F.substring("trade_time", 1, 8)
    return cleaning.clean_bars(raw.withColumn("batch", batch), BARS, "batch").drop("batch")


FLOW = {
    "ggt_ss": f"concat({CENTS}, '.005')",
    "ggt_sz": f"concat('-', {CENTS}, '.345')",
    "hgt": f"case when o_orderkey % 3 = 0 then '--' else {CENTS} end",
    "sgt": f"concat({CENTS}, 'd')",
    "north_money": f"concat(' ', {CENTS})",
    "south_money": "''",
}


@check(
    "post_moneyflow",
    "select cast(o_orderdate as date) as trade_date, "
    + ", ".join(f"{_duck_number(f'({e})', 'decimal(24,2)')} as {c}" for c, e in FLOW.items())
    + " from orders",
)
def post_moneyflow(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(F.expr(ORDER_DAY).alias("trade_date"), *[F.expr(e).alias(c) for c, e in FLOW.items()])
    return cleaning.clean(raw, SPECS["moneyflow_hsgt"])


@check(
    "post_multi_date",
    f"""select {sql_code('l_suppkey')} as ts_code, cast(l_shipdate as date) as end_date,
 cast(l_shipdate as date) as ann_date, case when l_linenumber % 2 = 0 then cast(l_shipdate as date) end as record_date,
 null::date as ex_date, cast(l_shipdate as date) as div_listdate, l_tax as cash_div from lineitem""",
)
def post_multi_date(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        code(F.col("l_suppkey")).alias("ts_code"),
        F.expr(f"cast({SHIP_DAY} as bigint)").alias("end_date"),
        F.expr(f"cast({SHIP_DAY} as double)").alias("ann_date"),
        F.expr(f"case when l_linenumber % 2 = 0 then {SHIP_DAY} end").alias("record_date"),
        F.lit("").alias("ex_date"),
        F.expr(f"concat({SHIP_DAY}, '.0')").alias("div_listdate"),
        F.col("l_tax").alias("cash_div"),
    )
    return cleaning.clean(raw, SPECS["dividend"])


@check(
    "purge_bad_keys",
    f"""select ts_code, trade_time, value from (
 select case when user_id % 11 <> 0 then {sql_code('user_id')} end as ts_code,
  case when event_id % 7 <> 0 then date_trunc('second', ts) end as trade_time, value from events)
where ts_code is not null and trade_time is not null""",
)
def purge_bad_keys(spark, sf_dir):
    zero = F.expr(f"case when event_id % 7 = 0 then '0000-00-00 00:00:00' else {TS_DIGITS} end")
    raw = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 11 != 0, code(F.col("user_id"))).alias("ts_code"), zero.alias("trade_time"), "value"
    )
    return cleaning.drop_null_keys(cleaning.normalize_timestamps(raw, "trade_time"), BARS.keys)


@check(
    "union_by_name",
    f"""with {SQL_FEEDS} select ts_code, trade_date, close, vol::double as vol, amount::double as amount, null::double as pe from daily
union all select ts_code, trade_date, close, null, null, pe from basic""",
)
def union_by_name(spark, sf_dir):
    from pyspark.sql import types as T

    from ..operators.merge import union_by_name as union

    schema = T.StructType.fromDDL("ts_code string, trade_date date, close double, vol double, amount double, pe double")
    as_text = daily(spark, sf_dir).withColumn("vol", F.col("vol").cast("string"))
    return union([as_text, basic(spark, sf_dir)], schema)


@check(
    "retention_keep",
    f"""with {SQL_CAL}, c as (select cal_date as cutoff from open_cal where cal_date <= date '2000-12-31' order by cal_date desc limit 1 offset 499)
select o_orderkey, day from (select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as day from orders), c
where day is null or day >= cutoff""",
)
def retention_keep(spark, sf_dir):
    from ..operators.calendar import cutoff_last_open_days
    from ..operators.retention import keep_recent

    cutoff = cutoff_last_open_days(calendar(spark, sf_dir), 500, date(2000, 12, 31)).scalar()
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    dated = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))
    return keep_recent(dated, F.col("day"), cutoff)
