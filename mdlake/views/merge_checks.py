"""Feed merge, duplicates, upsert, insert-ignore and schema evolution."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import cleaning, merge, quality
from ..operators.calendar import cutoff_last_open_days
from ..operators.retention import keep_recent
from ..plans.specs import SPECS
from .base import SQL_CAL, SQL_FEEDS, basic, calendar, check, daily, table

DAILY_KEYS = ("ts_code", "trade_date")
LINE_KEYS = ("l_orderkey", "l_linenumber")
# whole-row order, so that equal keys are decided the same way everywhere
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
SPLIT = "1999-01-01"

SQL_MERGED = f"""{SQL_FEEDS}, main_days as (select distinct trade_date from daily),
merged as (
 select coalesce(d.ts_code, b.ts_code) as ts_code, coalesce(d.trade_date, b.trade_date) as trade_date,
  case when d.ts_code is not null then d.close
       when b.trade_date not in (select trade_date from main_days) then b.close end as close,
  d.vol, d.amount, b.pe
 from daily d full join basic b on d.ts_code = b.ts_code and d.trade_date = b.trade_date)"""


@check("merge_daily", f"with {SQL_MERGED} select * from merged")
def merge_daily(spark, sf_dir):
    return merge.merge_feeds(daily(spark, sf_dir), basic(spark, sf_dir), DAILY_KEYS, "trade_date")


@check(
    "daily_refresh",
    f"""with {SQL_CAL}, {SQL_MERGED},
c as (select cal_date as cutoff from open_cal where cal_date <= date '2000-12-31' order by cal_date desc limit 1 offset 499)
select ts_code, trade_date, close, amount * 1000.0::double as amount, pe, vol * 100.0::double as vol_share
from merged, c where trade_date is null or trade_date >= cutoff""",
)
def daily_refresh(spark, sf_dir):
    """Flagship: land as text, clean, merge, and keep the last 500 open days."""
    spec = SPECS["daily_raw"]
    compact = F.translate(F.col("trade_date").cast("string"), "-", "")
    feeds = [f.withColumn("trade_date", compact) for f in (daily(spark, sf_dir), basic(spark, sf_dir))]
    main, extra = (cleaning.drop_null_keys(cleaning.clean(f, spec), spec.keys) for f in feeds)
    cutoff = cutoff_last_open_days(calendar(spark, sf_dir), spec.keep_open_days, date(2000, 12, 31)).first().cutoff
    recent = [keep_recent(f, F.col("trade_date"), cutoff) for f in (main, extra)]
    return merge.merge_feeds(*recent, spec.keys, "trade_date", null_safe=False)


def _sql_ranked(direction: str, source: str = "lineitem") -> str:
    # mirrors the order of LINE_ORDER in one direction
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return f"(select *, row_number() over (partition by l_orderkey, l_linenumber order by {order}) as rn from {source})"


COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax, l_shipdate"


@check("dedupe_last", f"select {COLUMNS} from {_sql_ranked('desc')} where rn = 1")
def dedupe_last(spark, sf_dir):
    return merge.last_per_key(table(spark, sf_dir, "lineitem"), LINE_KEYS, LINE_ORDER).select(*COLUMNS.split(", "))


@check("dedupe_first", f"select {COLUMNS} from {_sql_ranked('asc')} where rn = 1")
def dedupe_first(spark, sf_dir):
    return merge.first_per_key(table(spark, sf_dir, "lineitem"), LINE_KEYS, LINE_ORDER).select(*COLUMNS.split(", "))


def _target(spark, sf_dir):
    """Older line items, one per key: key, supplier, quantity, tax."""
    old = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz"))
    return merge.last_per_key(old, LINE_KEYS, LINE_ORDER).select(*LINE_KEYS, "l_suppkey", "l_quantity", "l_tax")


def _batch(spark, sf_dir):
    """Newer line items with duplicates: no tax, a new discount column, and the landing order."""
    new = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit(SPLIT).cast("timestamp_ntz"))
    seq = [F.col(c).alias(f"seq_{i}") for i, c in enumerate(LINE_ORDER)]
    return new.select(*LINE_KEYS, "l_suppkey", "l_quantity", "l_discount", *seq)


BATCH_ORDER = tuple(f"seq_{i}" for i in range(len(LINE_ORDER)))

SQL_SPLIT = f"""target as (
  select l_orderkey, l_linenumber, l_suppkey, l_quantity, l_tax
  from {_sql_ranked('desc', f"(select * from lineitem where l_shipdate < timestamp '{SPLIT}')")} where rn = 1),
new_last as (select * from {_sql_ranked('desc', f"(select * from lineitem where l_shipdate >= timestamp '{SPLIT}')")} where rn = 1),
new_first as (select * from {_sql_ranked('asc', f"(select * from lineitem where l_shipdate >= timestamp '{SPLIT}')")} where rn = 1)"""
SAME = "t.l_orderkey = n.l_orderkey and t.l_linenumber = n.l_linenumber"


@check(
    "upsert",
    f"""with {SQL_SPLIT}
select l_orderkey, l_linenumber, l_suppkey, l_quantity, l_tax, null::double as l_discount from target t
where not exists (select 1 from new_last n where {SAME})
union all select l_orderkey, l_linenumber, l_suppkey, l_quantity, null, l_discount from new_last""",
)
def upsert(spark, sf_dir):
    return merge.upsert(_target(spark, sf_dir), _batch(spark, sf_dir), LINE_KEYS, BATCH_ORDER)


@check(
    "upsert_keep_absent",
    f"""with {SQL_SPLIT}
select l_orderkey, l_linenumber, l_suppkey, l_quantity, l_tax, null::double as l_discount from target t
where not exists (select 1 from new_last n where {SAME})
union all select n.l_orderkey, n.l_linenumber, n.l_suppkey, n.l_quantity, t.l_tax, n.l_discount
from new_last n left join target t on {SAME}""",
)
def upsert_keep_absent(spark, sf_dir):
    return merge.upsert(_target(spark, sf_dir), _batch(spark, sf_dir), LINE_KEYS, BATCH_ORDER, keep_absent=True)


@check(
    "insert_ignore",
    f"""with {SQL_SPLIT} select l_orderkey, l_linenumber, l_suppkey, l_quantity, l_tax, null::double as l_discount from target
union all select l_orderkey, l_linenumber, l_suppkey, l_quantity, null, l_discount from new_first n
where not exists (select 1 from target t where {SAME})""",
)
def insert_ignore(spark, sf_dir):
    return merge.insert_ignore(_target(spark, sf_dir), _batch(spark, sf_dir), LINE_KEYS, BATCH_ORDER)


@check(
    "evolve_schema",
    f"with {SQL_SPLIT} select l_orderkey, l_linenumber, l_suppkey, l_quantity, l_tax, null::double as l_discount from target",
)
def evolve_schema(spark, sf_dir):
    batch = _batch(spark, sf_dir).drop(*BATCH_ORDER)
    return merge.evolve_schema(_target(spark, sf_dir), batch, LINE_KEYS)[0]


@check(
    "run_report",
    f"""with {SQL_SPLIT}, changes as (
 select n.l_suppkey, case when t.l_orderkey is null then 'inserted'
   when t.l_suppkey is not distinct from n.l_suppkey and t.l_quantity is not distinct from n.l_quantity
    then 'unchanged' else 'updated' end as change
 from new_last n left join target t on {SAME})
select l_suppkey, count(*) as rows_fetched, count(*) filter (change = 'inserted') as rows_inserted,
 count(*) filter (change = 'updated') as rows_updated, count(*) filter (change = 'unchanged') as rows_unchanged,
 count(*) filter (change = 'inserted') + 2 * count(*) filter (change = 'updated') as rows_affected
from changes group by 1""",
)
def run_report(spark, sf_dir):
    columns = [*LINE_KEYS, "l_suppkey", "l_quantity"]
    target = _target(spark, sf_dir).select(*columns)
    batch = _batch(spark, sf_dir).drop("l_discount")
    changes = merge.change_summary(target, batch, LINE_KEYS, BATCH_ORDER)
    winners = merge.last_per_key(batch, LINE_KEYS, BATCH_ORDER).select(*LINE_KEYS, "l_suppkey")
    return quality.run_report(changes.join(winners, list(LINE_KEYS)), ["l_suppkey"])
