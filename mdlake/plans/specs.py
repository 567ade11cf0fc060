"""The maintained tables: keys, cursor, retention, target schema and column rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    columns: str
    cursor: str | None = None
    keep_open_days: int | None = None
    by_open_day: bool = False
    exchange: str = "SSE"
    feeds: tuple[tuple[str, str], ...] = ()  # landed feeds and their raw columns, main feed first
    from_month_start: bool = False
    only: tuple[tuple[str, tuple[str, ...]], ...] = ()  # accepted values of raw columns, if they are filled
    dates: tuple[str, ...] = ()
    lots_to_shares: str | None = None
    thousands_to_units: str | None = None
    open_flag: str | None = None
    decimals: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    by_instrument: bool = True  # ``ts_code``, if there is one, names a single instrument

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    def landed(self) -> dict[str, T.StructType]:
        """Raw schema (all text) of each landed feed."""
        if self.feeds:
            named = {feed: columns.split() for feed, columns in self.feeds}
        else:
            stored = [n for n in self.schema.names if not (self.lots_to_shares and n == "vol_share")]
            extra = [*self.dates, *[column for column, _ in self.only]]
            extra += [self.lots_to_shares] if self.lots_to_shares else []
            named = {self.name: list(dict.fromkeys([*stored, *extra]))}
        return {
            feed: T.StructType([T.StructField(n, T.StringType()) for n in names]) for feed, names in named.items()
        }

    @property
    def day(self) -> str | None:
        """Date column that retention and partitions go by."""
        return None if self.keep_open_days is None else self.cursor


# The vendor's tables, their keys and columns, windows and accepted values.
_BARS = "ts_code string, trade_time timestamp_ntz, open double, high double, low double, close double, amount double, vol_share double"
_FLOW = (
    "net_amount double, net_amount_rate double, buy_elg_amount double, buy_elg_amount_rate double, "
    "buy_lg_amount double, buy_lg_amount_rate double, buy_md_amount double, buy_md_amount_rate double, "
    "buy_sm_amount double, buy_sm_amount_rate double"
)

_MONTHLY = dict(partition_by=("trade_month",))

ALL_SPECS = (
    TableSpec(
        "stock_basic",
        ("ts_code",),
        "ts_code string, symbol string, name string, area string, industry string, cnspell string, "
        "market string, list_date date, act_name string, act_ent_type string",
        dates=("list_date", "delist_date"),
        only=(("list_status", ("L",)),),
        by_instrument=False,
    ),
    TableSpec(
        "trade_cal",
        ("exchange", "cal_date"),
        "exchange string, cal_date date, is_open bigint, pretrade_date date",
        cursor="cal_date",
        dates=("cal_date", "pretrade_date"),
        only=(("exchange", ("SSE",)),),
        open_flag="is_open",
    ),
    TableSpec(
        "index_basic",
        ("ts_code",),
        "ts_code string, name string, market string, publisher string, category string, base_date date, "
        "base_point double, list_date date",
        dates=("base_date", "list_date", "exp_date"),
        by_instrument=False,
    ),
    TableSpec(
        "index_classify",
        ("index_code",),
        "index_code string, industry_name string, level string, industry_code string, is_pub string, "
        "parent_code string, src string",
    ),
    TableSpec(
        "index_member_all",
        ("ts_code", "l3_code"),
        "l1_code string, l1_name string, l2_code string, l2_name string, l3_code string, l3_name string, "
        "ts_code string, name string, in_date date, out_date date, is_new string",
        dates=("in_date", "out_date"),
        only=(("is_new", ("Y",)),),
    ),
    TableSpec(
        "daily_raw",
        ("ts_code", "trade_date"),
        "ts_code string, trade_date date, open double, high double, low double, close double, pre_close double, "
        "change double, pct_chg double, amount double, turnover_rate double, turnover_rate_f double, "
        "volume_ratio double, pe double, pe_ttm double, pb double, ps double, ps_ttm double, dv_ratio double, "
        "dv_ttm double, total_share double, float_share double, free_share double, total_mv double, "
        "circ_mv double, vol_share double",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        feeds=(
            ("daily", "ts_code trade_date open high low close pre_close change pct_chg vol amount"),
            (
                "daily_basic",
                "ts_code trade_date close turnover_rate turnover_rate_f volume_ratio pe pe_ttm pb ps ps_ttm "
                "dv_ratio dv_ttm total_share float_share free_share total_mv circ_mv",
            ),
        ),
        dates=("trade_date",),
        lots_to_shares="vol",
        thousands_to_units="amount",
        **_MONTHLY,
    ),
    TableSpec(
        "adj_factor",
        ("ts_code", "trade_date"),
        "ts_code string, trade_date date, adj_factor double",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        dates=("trade_date",),
        **_MONTHLY,
    ),
    TableSpec(
        "index_daily",
        ("ts_code", "trade_date"),
        "ts_code string, trade_date date, close double, open double, high double, low double, pre_close double, "
        "change double, pct_chg double, amount double, vol_share double",
        cursor="trade_date",
        keep_open_days=500,
        dates=("trade_date",),
        lots_to_shares="vol",
        only=(("ts_code", ("000001.SH", "000300.SH", "399001.SZ", "399006.SZ")),),
        **_MONTHLY,
        by_instrument=False,
    ),
    TableSpec(
        "index_weight",
        ("index_code", "con_code", "trade_date"),
        "index_code string, con_code string, trade_date date, weight double",
        cursor="trade_date",
        keep_open_days=2000,
        from_month_start=True,
        dates=("trade_date",),
        **_MONTHLY,
    ),
    TableSpec(
        "stk_limit",
        ("ts_code", "trade_date"),
        "trade_date date, ts_code string, up_limit double, down_limit double",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        dates=("trade_date",),
        **_MONTHLY,
    ),
    TableSpec(
        "limit_list_d",
        ("ts_code", "trade_date", "limit"),
        "trade_date date, ts_code string, industry string, name string, close double, pct_chg double, amount double, "
        "limit_amount double, float_mv double, total_mv double, turnover_ratio double, fd_amount double, "
        "first_time string, last_time string, open_times bigint, up_stat string, limit_times bigint, `limit` string",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        dates=("trade_date",),
        only=(("limit", ("U", "D", "Z")),),
        **_MONTHLY,
    ),
    TableSpec(
        "share_float",
        ("ts_code", "ann_date", "float_date", "holder_name", "share_type"),
        "ts_code string, ann_date date, float_date date, float_share double, float_ratio double, "
        "holder_name string, share_type string",
        cursor="float_date",
        keep_open_days=500,
        from_month_start=True,
        dates=("ann_date", "float_date"),
        **_MONTHLY,
    ),
    TableSpec(
        "dividend",
        ("ts_code", "ann_date", "end_date"),
        "ts_code string, end_date date, ann_date date, div_proc string, stk_div double, stk_bo_rate double, "
        "stk_co_rate double, cash_div double, cash_div_tax double, record_date date, ex_date date, pay_date date, "
        "div_listdate date, imp_ann_date date",
        cursor="ann_date",
        keep_open_days=500,
        dates=(
            "end_date", "ann_date", "record_date", "ex_date", "pay_date", "div_listdate", "imp_ann_date", "base_date",
        ),
        **_MONTHLY,
    ),
    TableSpec(
        "moneyflow_ind",
        ("ts_code", "trade_date"),
        f"trade_date date, ts_code string, name string, pct_change double, close double, {_FLOW}",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        dates=("trade_date",),
        **_MONTHLY,
        by_instrument=False,
    ),
    TableSpec(
        "moneyflow_sector",
        ("ts_code", "trade_date", "content_type"),
        f"trade_date date, content_type string, ts_code string, name string, pct_change double, close double, {_FLOW}, "
        "buy_sm_amount_stock string, rank bigint",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        dates=("trade_date",),
        **_MONTHLY,
        by_instrument=False,
    ),
    TableSpec(
        "moneyflow_mkt",
        ("trade_date",),
        f"trade_date date, close_sh double, pct_change_sh double, close_sz double, pct_change_sz double, {_FLOW}",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        dates=("trade_date",),
        **_MONTHLY,
    ),
    TableSpec(
        "moneyflow_hsgt",
        ("trade_date",),
        "trade_date date, ggt_ss decimal(24,2), ggt_sz decimal(24,2), hgt decimal(24,2), sgt decimal(24,2), "
        "north_money decimal(24,2), south_money decimal(24,2)",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        dates=("trade_date",),
        decimals=("ggt_ss", "ggt_sz", "hgt", "sgt", "north_money", "south_money"),
        **_MONTHLY,
    ),
    TableSpec(
        "st_list",
        ("ts_code", "start_date"),
        "ts_code string, name string, start_date date, end_date date, ann_date date, change_reason string",
        cursor="start_date",
        keep_open_days=500,
        feeds=(("namechange", "ts_code name start_date end_date ann_date change_reason"),),
        dates=("start_date", "end_date", "ann_date"),
        **_MONTHLY,
    ),
    TableSpec(
        "suspend_d",
        ("ts_code", "trade_date"),
        "ts_code string, trade_date date, suspend_timing string, suspend_type string",
        cursor="trade_date",
        keep_open_days=500,
        by_open_day=True,
        dates=("trade_date",),
        **_MONTHLY,
    ),
    TableSpec(
        "minute_5m",
        ("ts_code", "trade_time"),
        _BARS,
        cursor="trade_date",
        keep_open_days=250,
        by_open_day=True,
        lots_to_shares="volume",
        partition_by=("trade_day", "shard"),
    ),
)

SPECS: dict[str, TableSpec] = {spec.name: spec for spec in ALL_SPECS}

# The bar table is keyed by time; all others are keyed by a date or are dimensions.
BARS = SPECS["minute_5m"]
DAILY_SPECS = tuple(spec for spec in ALL_SPECS if spec is not BARS)

STATE_SCHEMA = "cluster string, table_name string, cursor_col string, cursor_value string, updated_at timestamp_ntz"
STATE_KEYS = ("cluster", "table_name", "cursor_col")


def calendar_years(max_keep_open_days: int) -> int:
    """Calendar years to load so that the widest retention window can be counted back."""
    if max_keep_open_days <= 0:
        return 5
    return max(5, max_keep_open_days // 200 + 2)


def update_order(tables: list[str]) -> list[str]:
    """Calendar first, instruments next, then the requested order without repeats."""
    early = ["trade_cal"] + [t for t in ("stock_basic",) if t in tables]
    return list(dict.fromkeys(early + tables))


def backfill_order(tables: list[str]) -> list[str]:
    """Registry order, without the calendar and the instruments, which are loaded first."""
    return [s.name for s in ALL_SPECS if s.name in tables and s.name not in ("trade_cal", "stock_basic")]
