"""Registry of checks and the market-data views derived from the given tables.

Each check is a query over whole tables plus the SQL that must give the same rows. The given tables
are not market data, so a few views cast them as such: orders give the calendar, lineitem two daily
feeds keyed by supplier code, events the bars keyed by user code, customers the instruments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- instrument codes ---------------------------------------------------------------------------


def code(number: Column) -> Column:
    text = number.cast("string")
    padded = F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text)
    suffix = F.when(number % 3 == 0, ".SZ").when(number % 3 == 1, ".SH").otherwise(".BJ")
    return F.concat(padded, suffix)


def sql_code(number: str) -> str:
    return (
        f"((case when {number} < 100000 then lpad(cast({number} as varchar), 6, '0') else cast({number} as varchar) end)"
        f" || (case {number} % 3 when 0 then '.SZ' when 1 then '.SH' else '.BJ' end))"
    )


def sql_shard(code_expr: str) -> str:
    return f"('P' || (1 + ('0x' || substr(md5({code_expr}), 1, 8))::bigint % 3))"


def weekday(day: Column) -> Column:
    return F.pmod(F.datediff(day, F.lit("1995-01-02").cast("date")), F.lit(7)) < 5


def sql_weekday(day: str) -> str:
    return f"(isodow({day}) <= 5)"


# --- calendar -----------------------------------------------------------------------------------


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("cal_date")).distinct()
    return days.select(
        F.lit("SSE").alias("exchange"), "cal_date", weekday(F.col("cal_date")).cast("bigint").alias("is_open")
    )


SQL_CAL = f"""cal as (
  select distinct 'SSE' as exchange, cast(o_orderdate as date) as cal_date,
         {sql_weekday('cast(o_orderdate as date)')}::bigint as is_open from orders),
open_cal as (select cal_date from cal where is_open = 1)"""


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("cal_date")).distinct()
    return days.select(
        F.lit("SSE").alias("exchange"), "cal_date", weekday(F.col("cal_date")).cast("bigint").alias("is_open")
    )


SQL_EVENT_CAL = f"""ecal as (
  select distinct cast(ts as date) as cal_date, {sql_weekday('cast(ts as date)')}::bigint as is_open from events),
open_ecal as (select cal_date from ecal where is_open = 1)"""


# --- daily feeds ----------------------------------------------------------------------------------


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and volume, landed on open days only."""
    li = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'")
    day = F.col("l_shipdate").cast("date")
    return (
        li.where(weekday(day))
        .groupBy(code(F.col("l_suppkey")).alias("ts_code"), day.alias("trade_date"))
        .agg(
            F.max("l_extendedprice").alias("close"),
            F.sum("l_quantity").cast("bigint").alias("vol"),
            F.sum("l_linenumber").cast("bigint").alias("amount"),
        )
    )


def basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios, landed on every day; overlaps the price feed in ``close``."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(
        code(F.col("l_suppkey")).alias("ts_code"), F.col("l_shipdate").cast("date").alias("trade_date")
    ).agg(F.min("l_extendedprice").alias("close"), F.max("l_tax").alias("pe"))


SQL_FEEDS = f"""daily as (
  select {sql_code('l_suppkey')} as ts_code, cast(l_shipdate as date) as trade_date, max(l_extendedprice) as close,
         sum(l_quantity)::bigint as vol, sum(l_linenumber)::bigint as amount
  from lineitem where l_returnflag <> 'R' and {sql_weekday('cast(l_shipdate as date)')} group by 1, 2),
basic as (
  select {sql_code('l_suppkey')} as ts_code, cast(l_shipdate as date) as trade_date, min(l_extendedprice) as close,
         max(l_tax) as pe
  from lineitem group by 1, 2)"""


# --- bars -------------------------------------------------------------------------------------------


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute bars per user code; volume counts events."""
    ev = table(spark, sf_dir, "events")
    at = F.struct("ts", "event_id")
    return ev.groupBy(code(F.col("user_id")).alias("ts_code"), F.window("ts", "5 minutes")["start"].alias("trade_time")).agg(
        F.min_by("value", at).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", at).alias("close"),
        F.count(F.lit(1)).alias("volume"),
        F.sum("event_id").alias("amount"),
    )


SQL_BARS = f"""bars as (
  select {sql_code('user_id')} as ts_code, time_bucket(interval 5 minutes, ts) as trade_time,
         arg_min(value, (ts, event_id)) as open, max(value) as high, min(value) as low,
         arg_max(value, (ts, event_id)) as close, count(*) as volume, sum(event_id)::bigint as amount
  from events group by 1, 2)"""


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(code(F.col("c_custkey")).alias("ts_code"), "*")
