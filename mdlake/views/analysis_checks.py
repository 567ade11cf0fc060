"""Joins on time, periods, differences, frames, runs and levels over the market views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, difference, frames, intervals, islands, levels
from .base import SQL_BARS, SQL_CAL, SQL_FEEDS, bars, calendar, check, code, daily, sql_code, table

# --- as-of joins ------------------------------------------------------------------------------------


def factors(spark, sf_dir):
    """Price factors, announced on the ship days of returned lines."""
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    day = F.col("l_shipdate").cast("date")
    return returned.groupBy(code(F.col("l_suppkey")).alias("ts_code"), day.alias("ann_date")).agg((1 + F.max("l_tax")).alias("factor"))


SQL_FACTORS = f"""factors as (
  select {sql_code('l_suppkey')} as ts_code, cast(l_shipdate as date) as ann_date, 1 + max(l_tax) as factor
  from lineitem where l_returnflag = 'R' group by 1, 2)"""


@check(
    "asof_factor",
    f"""with {SQL_FEEDS}, {SQL_FACTORS}
select d.ts_code, trade_date, close, ann_date, factor, close * factor as adj_close
from daily d asof left join factors f on d.ts_code = f.ts_code and d.trade_date >= f.ann_date""",
)
def asof_factor(spark, sf_dir):
    """Prices adjusted by the newest factor known on their day."""
    prices = daily(spark, sf_dir).select("ts_code", "trade_date", "close")
    joined = asof.asof_join(prices, factors(spark, sf_dir), ["ts_code"], "trade_date", "ann_date")
    return joined.withColumn("adj_close", F.col("close") * F.col("factor"))


@check(
    "asof_quote_within",
    f"""with {SQL_BARS}, quotes as (
  select {sql_code('user_id')} as ts_code, ts, arg_max(value, event_id) as quote from events where event_type = 'click' group by 1, 2)
select b.ts_code, trade_time, close, case when trade_time <= ts + interval 6 hours then quote end as quote,
       case when trade_time <= ts + interval 6 hours then ts end as quote_time
from bars b asof left join quotes q on b.ts_code = q.ts_code and b.trade_time > q.ts""",
)
def asof_quote_within(spark, sf_dir):
    """Bars with the last quote before them that is at most six hours old; of quotes at one moment the last counts."""
    clicks = table(spark, sf_dir, "events").where("event_type = 'click'")
    quotes = clicks.select(code(F.col("user_id")).alias("ts_code"), F.col("ts").alias("quote_time"), F.col("value").alias("quote"), "event_id")
    left = bars(spark, sf_dir).select("ts_code", "trade_time", "close")
    six_hours = F.make_dt_interval(F.lit(0), F.lit(6))
    return asof.asof_join(left, quotes, ["ts_code"], "trade_time", "quote_time", strict=True, within=six_hours, order=["event_id"])


# --- periods ------------------------------------------------------------------------------------------


def suspensions(spark, sf_dir):
    """Periods from the ship day of a line over as many days as its quantity; the largest have not ended."""
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_linenumber = 1")
    first = F.col("l_shipdate").cast("date")
    last = F.when(F.col("l_quantity") < 48, F.date_add(first, F.col("l_quantity").cast("int")))
    return lines.select(code(F.col("l_suppkey")).alias("ts_code"), first.alias("susp_from"), last.alias("susp_to")).distinct()


SQL_SUSPENSIONS = f"""suspensions as (
  select distinct {sql_code('l_suppkey')} as ts_code, cast(l_shipdate as date) as susp_from,
         case when l_quantity < 48 then cast(l_shipdate as date) + l_quantity::integer end as susp_to
  from lineitem where l_returnflag = 'R' and l_linenumber = 1)"""


@check(
    "interval_join",
    f"""with {SQL_FEEDS}, {SQL_SUSPENSIONS}
select ts_code, trade_date, close, susp_from, susp_to from daily join suspensions using (ts_code)
where trade_date between susp_from and coalesce(susp_to, date '9999-12-31')""",
)
def interval_join(spark, sf_dir):
    """Every price inside a suspension, open ends included."""
    prices = daily(spark, sf_dir).select("ts_code", "trade_date", "close")
    return intervals.interval_join(prices, suspensions(spark, sf_dir), ["ts_code"], "trade_date", "susp_from", "susp_to")


@check(
    "merged_periods",
    f"""with {SQL_SUSPENSIONS}, marked as (
  select *, susp_from > 1 + max(coalesce(susp_to, date '9999-12-30')) over (
           partition by ts_code order by susp_from, susp_to rows between unbounded preceding and 1 preceding) as fresh
  from suspensions), numbered as (
  select *, count(*) filter (coalesce(fresh, true)) over (partition by ts_code order by susp_from, susp_to rows unbounded preceding) as run from marked)
select ts_code, min(susp_from) as susp_from, case when count(*) = count(susp_to) then max(susp_to) end as susp_to from numbered group by ts_code, run""",
)
def merged_periods(spark, sf_dir):
    return intervals.merged_periods(suspensions(spark, sf_dir), ["ts_code"], "susp_from", "susp_to")


@check(
    "tradable_days",
    f"""with {SQL_FEEDS}, {SQL_SUSPENSIONS}
select ts_code, trade_date, close, exists (
  select 1 from suspensions s where s.ts_code = d.ts_code and susp_to is not null and trade_date between susp_from and susp_to) as covered
from daily d""",
)
def tradable_days(spark, sf_dir):
    """Whether an ended suspension covers a price's day."""
    prices = daily(spark, sf_dir).select("ts_code", "trade_date", "close")
    ended = suspensions(spark, sf_dir).where("susp_to is not null")
    return intervals.covered(prices, ended, ["ts_code"], "trade_date", "susp_from", "susp_to")


# --- differences ----------------------------------------------------------------------------------------


def line_versions(spark, sf_dir):
    """Lines as they were and as they are: some gone, some dearer, some twice."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    marked = table(spark, sf_dir, "lineitem").where("l_orderkey % 97 <> 0")
    changed = F.when(F.col("l_orderkey") % 89 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    flag = F.when(F.col("l_orderkey") % 79 != 0, F.col("l_returnflag"))
    times = F.when(F.col("l_orderkey") % 83 == 0, 2).otherwise(1)
    new = marked.select("l_suppkey", "l_linenumber", changed.alias("l_quantity"), flag.alias("l_returnflag"), F.explode(F.sequence(F.lit(1), times)))
    return lines, new.drop("col")


SQL_VERSIONS = """old as (select l_suppkey, l_linenumber, l_quantity, l_returnflag from lineitem),
new as (
  select l_suppkey, l_linenumber, case when l_orderkey % 89 = 0 then l_quantity + 1 else l_quantity end as l_quantity,
         case when l_orderkey % 79 <> 0 then l_returnflag end as l_returnflag
  from lineitem, range(1, case when l_orderkey % 83 = 0 then 3 else 2 end) where l_orderkey % 97 <> 0)"""


@check("except_all", f"with {SQL_VERSIONS} select * from old except all select * from new")
def except_all(spark, sf_dir):
    return difference.except_all(*line_versions(spark, sf_dir))


@check("intersect_all", f"with {SQL_VERSIONS} select * from old intersect all select * from new")
def intersect_all(spark, sf_dir):
    return difference.intersect_all(*line_versions(spark, sf_dir))


@check(
    "row_changes",
    f"""with {SQL_VERSIONS}
select *, 'deleted' as change, count(*) as n_rows from (select * from old except all select * from new) group by all
union all
select *, 'inserted' as change, count(*) as n_rows from (select * from new except all select * from old) group by all""",
)
def row_changes(spark, sf_dir):
    return difference.row_changes(*line_versions(spark, sf_dir))


@check(
    "keyed_changes",
    """with new as (
  select case when o_orderkey % 89 = 0 then o_orderkey + 10000000 else o_orderkey end as o_orderkey,
         case when o_orderkey % 83 = 0 then null else o_orderstatus end as o_orderstatus, o_totalprice
  from orders where o_orderkey % 97 <> 0),
old as (select o_orderkey, o_orderstatus, o_totalprice from orders)
select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey,
       case when o.o_orderkey is null then 'inserted' when n.o_orderkey is null then 'deleted' else 'changed' end as change,
       o.o_orderstatus as old_status, n.o_orderstatus as new_status, o.o_totalprice as old_price, n.o_totalprice as new_price
from old o full join new n on o.o_orderkey = n.o_orderkey
where o.o_orderkey is null or n.o_orderkey is null or o.o_orderstatus is distinct from n.o_orderstatus""",
)
def keyed_changes(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    new = old.where(key % 97 != 0).select(
        F.when(key % 89 == 0, key + 10_000_000).otherwise(key).alias("o_orderkey"),
        F.when(key % 83 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
    )
    found = difference.keyed_changes(old, new, ["o_orderkey"])
    return found.select(
        "o_orderkey", "change",
        F.col("old.o_orderstatus").alias("old_status"), F.col("new.o_orderstatus").alias("new_status"),
        F.col("old.o_totalprice").alias("old_price"), F.col("new.o_totalprice").alias("new_price"),
    )


# --- frames, runs, levels ---------------------------------------------------------------------------------


@check(
    "range_frames",
    f"""with {SQL_FEEDS}, cents as (select ts_code, trade_date, close, round(close * 100)::bigint as c from daily), framed as (
  select ts_code, trade_date, close, count(*) over w as n_prices, first_value(close) over w as first_close,
         sum(c) over w as s, sum(c * c) over w as q
  from cents window w as (partition by ts_code order by trade_date range between interval 29 days preceding and current row))
select ts_code, trade_date, close, n_prices, close / first_close - 1 as return_30d,
       case when n_prices > 1 then sqrt((n_prices * q - s * s)::double / (n_prices * (n_prices - 1))::double) end as volatility_30d
from framed""",
)
def range_frames(spark, sf_dir):
    """Return and volatility over the last 30 calendar days, whatever days are missing."""
    cents = F.round(F.col("close") * 100).cast("bigint")
    prices = daily(spark, sf_dir).select("ts_code", "trade_date", "close", cents.alias("c"))
    framed = frames.over_days(
        prices,
        ["ts_code"],
        "trade_date",
        30,
        {
            "n_prices": F.count(F.lit(1)),
            "first_close": F.first("close"),
            "s": F.sum("c"),
            "q": F.sum(F.col("c") * F.col("c")),
        },
    )
    n, s = F.col("n_prices"), F.col("s")
    spread = (n * F.col("q") - s * s).cast("double") / (n * (n - 1)).cast("double")
    return framed.select(
        "ts_code", "trade_date", "close", "n_prices",
        (F.col("close") / F.col("first_close") - 1).alias("return_30d"),
        F.when(n > 1, F.sqrt(spread)).alias("volatility_30d"),
    )


SQL_OPEN_POSITIONS = f"""{SQL_CAL}, numbered as (select cal_date, row_number() over (order by cal_date) as pos from open_cal),
placed as (select distinct ts_code, pos from daily join numbered on trade_date = cal_date)"""


@check(
    "open_day_runs",
    f"""with {SQL_FEEDS}, {SQL_OPEN_POSITIONS}, grouped as (
  select ts_code, min(pos) as a, max(pos) as b, count(*) as n_days
  from (select ts_code, pos, pos - row_number() over (partition by ts_code order by pos) as run from placed) group by ts_code, run)
select ts_code, x.cal_date as first_day, y.cal_date as last_day, n_days
from grouped join numbered x on x.pos = a join numbered y on y.pos = b""",
)
def open_day_runs(spark, sf_dir):
    return islands.open_day_runs(daily(spark, sf_dir), calendar(spark, sf_dir), ["ts_code"], "trade_date")


@check(
    "missing_open_days",
    f"""with {SQL_FEEDS}, {SQL_OPEN_POSITIONS}, spans as (select ts_code, min(pos) as a, max(pos) as b from placed group by ts_code)
select ts_code, cal_date as trade_date from spans join numbered on pos between a and b
where not exists (select 1 from placed p where p.ts_code = spans.ts_code and p.pos = numbered.pos)""",
)
def missing_open_days(spark, sf_dir):
    return islands.missing_open_days(daily(spark, sf_dir), calendar(spark, sf_dir), ["ts_code"], "trade_date")


@check(
    "bar_runs",
    f"""with {SQL_BARS}, placed as (select ts_code, epoch(trade_time)::bigint // 300 as slot from bars)
select ts_code, min(slot) as first_pos, max(slot) as last_pos, count(*) as n_pos
from (select *, slot - row_number() over (partition by ts_code order by slot) as run from placed) group by ts_code, run""",
)
def bar_runs(spark, sf_dir):
    """Runs of five-minute slots with trades."""
    slots = bars(spark, sf_dir).select("ts_code", F.floor(F.unix_timestamp("trade_time") / 300).alias("slot"))
    return islands.runs(slots, ["ts_code"], "slot")


@check(
    "cube_levels",
    """select concat_ws(',', case when grouping(event_type) = 0 then 'event_type' end, case when grouping(day) = 0 then 'day' end,
                 case when grouping(parity) = 0 then 'parity' end) as level,
       event_type, day, parity, sum(event_id)::bigint as ids, count(*) as n_rows, count(distinct user_id) as n_users
from (select event_type, cast(ts as date) as day, case when event_id % 3 <> 0 then event_id % 2 end as parity, event_id, user_id from events)
group by cube (event_type, day, parity)""",
)
def cube_levels(spark, sf_dir):
    """Sums, rows and distinct users of every combination of three dimensions, one of them with nulls."""
    ev = table(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("date").alias("day"), F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 2).alias("parity"), "event_id", "user_id"
    )
    return levels.grouping_sets(ev, levels.cube(["event_type", "day", "parity"]), {"ids": F.col("event_id")}, "user_id", "n_users")
