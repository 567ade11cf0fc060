"""Reshaping, profiles, completeness, drift and repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import cleaning, quality, reshape
from ..plans import repair
from ..session import scratch_path
from ..sources.lake import LakeTable
from .base import SQL_BARS, bars, check, sql_shard, table
from .cleaning_checks import CENTS, RAW_NUMBER, _duck_number

FIELDS = ("open", "high", "low", "close", "volume", "amount")


@check(
    "bars_from_code_frames",
    f"with {SQL_BARS} select ts_code, trade_time, high, low, volume from bars",
)
def bars_from_code_frames(spark, sf_dir):
    frames = bars(spark, sf_dir).select(
        F.col("trade_time").alias("index"), "high", "low", F.col("ts_code").alias("frame"), "volume"
    )
    return reshape.bars_from_code_frames(frames, "frame")


# Event types play the instruments of the time-by-code matrices, days the columns of the other layout.
TYPE_CODE = "concat(upper(event_type), '.SH')"
SQL_TYPE_BARS = f"""tb as (
 select {TYPE_CODE} as ts_code, time_bucket(interval 5 minutes, ts) as trade_time, max(value) as high, min(value) as low,
  count(*)::double as volume from events group by 1, 2)"""


def _type_bars(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.expr(TYPE_CODE).alias("ts_code"), F.window("ts", "5 minutes")["start"].alias("trade_time")).agg(
        F.max("value").alias("high"), F.min("value").alias("low"), F.count(F.lit(1)).cast("double").alias("volume")
    )


def _labels(df, column):
    """Matrix column labels (event types or days), read from the data."""
    return [r[0] for r in df.select(column).distinct().orderBy(column).collect()]


@check(
    "bars_from_matrices",
    f"""with {SQL_TYPE_BARS} select c.ts_code, t.trade_time, high, low, volume
from (select distinct ts_code from tb) c join (select distinct trade_time from tb) t on true
left join tb on tb.ts_code = c.ts_code and tb.trade_time = t.trade_time""",
)
def bars_from_matrices(spark, sf_dir):
    long = _type_bars(spark, sf_dir)
    codes = _labels(long, "ts_code")
    matrices = {f: long.groupBy("trade_time").pivot("ts_code", codes).agg(F.first(f)) for f in ("high", "low", "volume")}
    return reshape.bars_from_matrices(matrices, "trade_time")


SQL_DAY_BARS = f"""{SQL_BARS}, db as (
 select ts_code, strftime(trade_time, '%Y%m%d') || '150000' as trade_time, max(high) as high, sum(volume)::double as volume
 from bars group by 1, 2)"""


@check(
    "bars_from_matrices_by_code",
    f"""with {SQL_DAY_BARS} select c.ts_code, t.trade_time, high, volume
from (select distinct ts_code from db) c join (select distinct trade_time from db) t on true
left join db on db.ts_code = c.ts_code and db.trade_time = t.trade_time""",
)
def bars_from_matrices_by_code(spark, sf_dir):
    stamp = F.concat(dates.compact_date(F.col("trade_time")), F.lit("150000"))
    long = bars(spark, sf_dir).groupBy("ts_code", stamp.alias("trade_time")).agg(
        F.max("high").alias("high"), F.sum("volume").cast("double").alias("volume")
    )
    times = _labels(long, "trade_time")
    matrices = {f: long.groupBy("ts_code").pivot("trade_time", times).agg(F.first(f)) for f in ("high", "volume")}
    return reshape.bars_from_matrices(matrices, "ts_code")


# --- completeness ---------------------------------------------------------------------------------

PAGE_ROWS, PAGES_PER_UNIT = 1000, 6


@check(
    "page_completeness",
    f"""with r as (
 select 'orders' as feed, o_orderkey as k from orders union all select distinct 'lines', l_orderkey from lineitem),
p as (select feed, k // {PAGE_ROWS * PAGES_PER_UNIT} as unit, (k // {PAGE_ROWS}) % {PAGES_PER_UNIT} as page, count(*) as n from r group by 1, 2, 3),
u as (select feed, unit, count(*) as n_pages, sum(n)::bigint as n_rows, max(page) + 1 - count(*) as missing_pages,
 count(*) filter (n < {PAGE_ROWS}) as short_pages, count(*) filter (n > {PAGE_ROWS}) as overfull_pages, arg_max(n, page) as last_rows from p group by 1, 2)
select *, last_rows = {PAGE_ROWS} as possibly_truncated,
 missing_pages = 0 and overfull_pages = 0 and short_pages = 1 and last_rows < {PAGE_ROWS} as complete from u""",
)
def page_completeness(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.lit("orders").alias("feed"), F.col("o_orderkey").alias("k"))
    lines = table(spark, sf_dir, "lineitem").select(F.lit("lines").alias("feed"), F.col("l_orderkey").alias("k")).distinct()
    rows = orders.union(lines).select(
        "feed",
        F.expr(f"k div {PAGE_ROWS * PAGES_PER_UNIT}").alias("unit"),
        F.expr(f"(k div {PAGE_ROWS}) % {PAGES_PER_UNIT}").alias("page"),
    )
    return quality.page_completeness(rows, ["feed", "unit"], "page", PAGE_ROWS)


# --- profiles and types -----------------------------------------------------------------------------

RAW_PROFILE = {
    "o_orderkey": "o_orderkey",
    "trade_date": "replace(cast(cast(o_orderdate as date) as varchar(10)), '-', '')",
    "market": "o_orderstatus",
    "pe": f"case when o_orderkey % 3 <> 0 then {CENTS} end",
    "note": f"repeat(o_orderpriority, {{n}})",
    "empty": "cast(null as varchar(5))",
    "north_money": CENTS,
    "trade_time": "o_orderdate",
    "stamped": "o_orderdate",
    "total": "o_totalprice",
}
RAW_PROFILE["note"] = "repeat(o_orderpriority, cast(5 + o_orderkey % 30 as int))"
MEASURED = ("trade_date", "market", "pe", "note", "empty", "north_money")


@check(
    "column_profile",
    " union all ".join(
        f"select '{c}' as column_name, coalesce(max(length({e})), 0) as max_length, count(*) filter ({e} is null) as n_null, count(*) as n_rows from orders"
        for c, e in RAW_PROFILE.items()
        if c in MEASURED
    ),
)
def column_profile(spark, sf_dir):
    return quality.column_profile(table(spark, sf_dir, "orders").select(*[F.expr(RAW_PROFILE[c]).alias(c) for c in MEASURED]))


INFERRED = {
    "o_orderkey": (5, "'BIGINT'"),
    "trade_date": (3, "'DATE'"),
    "market": (2, "'VARCHAR(32)'"),
    "pe": (8, None),
    "note": (8, None),
    "empty": (8, None),
    "north_money": (1, "'DECIMAL(24,2)'"),
    "trade_time": (4, "'DATETIME'"),
    "stamped": (7, "'DATETIME'"),
    "total": (6, "'FLOAT'"),
}


def _sql_inferred(name: str) -> str:
    rule, fixed = INFERRED[name]
    width = f"coalesce(max(length({RAW_PROFILE[name]})), 0)"
    by_width = f"case when {width} <= 64 then 'VARCHAR(64)' when {width} <= 255 then 'VARCHAR(255)' else 'TEXT' end"
    return f"select '{name}' as column_name, {rule} as rule, {fixed or by_width} as inferred_type from orders having count(*) > 0"


@check("infer_types", " union all ".join(_sql_inferred(c) for c in INFERRED))
def infer_types(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(*[F.expr(e).alias(c) for c, e in RAW_PROFILE.items()])
    return quality.infer_types(raw).drop("max_length")


# --- drift and repair ---------------------------------------------------------------------------------

TEXT_COLUMNS = {"open": RAW_NUMBER, "high": CENTS, "low": "case o_orderkey % 3 when 0 then '1-2' when 1 then '1e3' else '' end"}


def _text_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", *[F.expr(e).alias(c) for c, e in TEXT_COLUMNS.items()])


def _sql_bad(raw: str) -> tuple[str, str]:
    chars = f"({raw} <> '' and regexp_matches({raw}, '[^0-9.\\-]'))"
    return chars, f"({raw} <> '' and {_duck_number(raw)} is null)"


@check(
    "convertibility",
    " union all ".join(
        f"select '{c}' as column_name, count({c}) as n_values, count(*) filter {'(' + _sql_bad(c)[0] + ')'} as bad_characters,"
        f" count(*) filter {'(' + _sql_bad(c)[1] + ')'} as bad_casts from (select {e} as {c} from orders)"
        for c, e in TEXT_COLUMNS.items()
    ),
)
def convertibility(spark, sf_dir):
    return quality.convertibility(_text_orders(spark, sf_dir), list(TEXT_COLUMNS))


SQL_REPAIRED = (
    "select o_orderkey, "
    + ", ".join(
        f"case when not coalesce({_sql_bad(c)[0]}, false) and not coalesce({_sql_bad(c)[1]}, false) then try_cast(trim({c}) as decimal(24,2)) end as {c}"
        for c in TEXT_COLUMNS
    )
    + " from (select o_orderkey, "
    + ", ".join(f"{e} as {c}" for c, e in TEXT_COLUMNS.items())
    + " from orders)"
)


@check("repair_types", SQL_REPAIRED)
def repair_types(spark, sf_dir):
    return quality.repair_types(_text_orders(spark, sf_dir), list(TEXT_COLUMNS))


@check("repair_table", SQL_REPAIRED)
def repair_table(spark, sf_dir):
    """The same on a stored table: a dry run first, then a new revision."""
    rows = _text_orders(spark, sf_dir)
    stored = LakeTable(spark, scratch_path(spark, "drifted"), rows.schema)
    stored.replace(rows, [""])
    planned = repair.repair_table(stored, list(TEXT_COLUMNS))
    assert planned.text_columns == tuple(TEXT_COLUMNS) and not planned.applied
    repair.repair_table(stored, list(TEXT_COLUMNS), apply=True)
    return stored.rows()


@check(
    "schema_drift",
    f"""with {SQL_BARS}, s as (
 select {sql_shard('ts_code')} as shard, case when volume > 1 then 'n/a' else cast(high as varchar) end as high, amount from bars)
select column_name, types, n_types, text_shards, missing_shards, n_values, bad_casts from (
 select 'high' as column_name, 'double,string' as types, 2 as n_types, 'P3' as text_shards, 0 as missing_shards,
  count(*) filter (shard = 'P3') as n_values, count(*) filter (shard = 'P3' and high = 'n/a') as bad_casts from s
 union all select 'turnover', 'bigint', 1, '', 2, 0, 0)""",
)
def schema_drift(spark, sf_dir):
    """Shards read apart: one stores prices as text, one has a column the others lack."""
    routed = cleaning.with_shard(bars(spark, sf_dir))
    text_high = F.when(F.col("volume") > 1, "n/a").otherwise(F.col("high").cast("string"))
    shards = {name: routed.where(F.col("shard") == name).drop("shard") for name in ("P1", "P2", "P3")}
    shards["P2"] = shards["P2"].withColumn("turnover", F.col("amount"))
    shards["P3"] = shards["P3"].withColumn("high", text_high)
    drift = quality.schema_drift(shards, ["open", "high", "low", "close", "amount"])
    counts = quality.convertibility(shards["P3"], ["high"]).select("column_name", "n_values", "bad_casts")
    return drift.join(counts, "column_name", "left").fillna(0, ["n_values", "bad_casts"])
