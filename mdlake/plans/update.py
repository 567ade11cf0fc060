"""Batch update of the daily tables: plan, read, clean, merge, advance the cursor, enforce retention.

Data is written before the cursor. A run that stops in between is repeated by the next one, and the
keyed merge makes the repetition harmless.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import astuple, dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import month_label
from ..operators import calendar as cal_ops, cleaning, merge, retention, state, windows
from ..session import in_short_methods, local_frame, staged
from ..sources.lake import LakeTable
from ..sources.landed import FILES, LANDING_ORDER, added_columns, file_name, landed_or_none, list_files
from .specs import BARS, SPECS, STATE_KEYS, STATE_SCHEMA, TableSpec, backfill_order, calendar_years, update_order

MASTER = "MASTER"
# Texts of numbers that are not finite.
NOT_FINITE = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


@dataclass(frozen=True)
class TablePlan:
    table: str
    start: date
    end: date
    cutoff: date | None
    cursor: date | None


@dataclass
class TableReport:
    table: str
    start: str
    end: str
    rows_fetched: int = 0
    rows_inserted: int = 0
    rows_deleted: int = 0
    cursor_col: str | None = None
    cursor_value: str | None = None
    retention_cutoff: str | None = None
    added_columns: tuple[str, ...] = ()
    # only counted on request: rows that changed a stored one, that equal it, and that lack a part of their key; the
    # count a server would report as affected; landed files that are exactly one full page, so that a page may be missing
    rows_updated: int | None = None
    rows_unchanged: int | None = None
    rows_dropped: int | None = None
    rows_not_finite: int | None = None
    rows_affected: int | None = None
    pages_truncated: int | None = None


class Lake:
    """Where landed extracts are read from and tables are kept.

    ``index_codes`` are the indices whose weights are wanted; without any, none are loaded.
    """

    def __init__(
        self, spark: SparkSession, root: str, landing: str, fmt: str = "json", index_codes: Sequence[str] = ()
    ):
        self.spark, self.root, self.landing, self.fmt = spark, root.rstrip("/"), landing.rstrip("/"), fmt
        self.index_codes = tuple(index_codes)

    def accepted(self, spec: TableSpec) -> dict[str, tuple[str, ...]]:
        """Accepted values per raw column of a table's feeds."""
        return dict(spec.only) | ({"index_code": self.index_codes} if spec.name == "index_weight" else {})

    def table(self, spec: TableSpec) -> LakeTable:
        return LakeTable(self.spark, f"{self.root}/{spec.name}", spec.schema, spec.partition_by, spec.keys)

    def state(self) -> LakeTable:
        return LakeTable(self.spark, f"{self.root}/etl_state", STATE_SCHEMA)

    def calendar(self) -> DataFrame:
        return self.table(SPECS["trade_cal"]).rows()

    def cursors(self, cursor_col: str | None = None) -> DataFrame:
        rows = self.state().rows()
        return rows if cursor_col is None else rows.where(F.col("cursor_col") == cursor_col)

    def save_cursors(self, rows: Sequence[tuple[str, str, str, str | None]], now: datetime) -> None:
        """Store (cluster, table, cursor column, value) rows; the state holds one row per table and shard."""
        if not rows:
            return
        changes = local_frame(self.spark, rows, "cluster string, table_name string, cursor_col string, cursor_value string")
        stamped = changes.withColumn("updated_at", F.lit(now).cast("timestamp_ntz"))
        table = self.state()
        at = table.snapshot()
        # one row per table and shard, so a single task is enough
        table.replace(merge.upsert(table.read(at=at).coalesce(1), stamped.coalesce(1), STATE_KEYS, ()), [""], at)


def with_partitions(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Derive the partition columns from the key columns, so a row never changes partition."""
    if "trade_month" in spec.partition_by:
        df = df.withColumn("trade_month", month_label(F.col(spec.day)))
    if "trade_day" in spec.partition_by:
        df = df.withColumn("trade_day", F.col("trade_time").cast("date").cast("string"))
    if "shard" in spec.partition_by and "shard" not in df.columns:
        df = cleaning.with_shard(df)
    return df


def retention_cutoff(lake: Lake, keep: int, end: date, exchange: str) -> date:
    cutoff = cal_ops.cutoff_last_open_days(lake.calendar(), keep, end, exchange).first().cutoff
    if cutoff is None:
        raise ValueError(f"the calendar has fewer than {keep} open days up to {end}; load more of trade_cal first")
    return cutoff


def plan_tables(
    lake: Lake, specs: Iterable[TableSpec], end: date, start: date | None = None, lookback_days: int = 0, no_delete: bool = False
) -> dict[str, TablePlan]:
    """Start day, cutoff and cursor of several tables in one small query."""
    specs = list(specs)
    keeps = {(s.keep_open_days, s.exchange) for s in specs if s.keep_open_days and not no_delete}
    cutoffs = {k: retention_cutoff(lake, k[0], end, k[1]) for k in sorted(keeps)}
    wanted = [
        (s.name, s.cursor, start, None if no_delete else cutoffs.get((s.keep_open_days, s.exchange))) for s in specs
    ]
    ddl = "table_name string, cursor_col string, requested date, cutoff date"
    rows = local_frame(lake.spark, wanted, ddl)
    known = lake.cursors().where(F.col("cluster") == MASTER).select(
        "table_name", "cursor_col", state.cursor_date(F.col("cursor_value")).alias("cursor")
    )
    begin = state.plan_start(F.col("requested"), F.col("cursor"), F.col("cutoff"), F.lit(end), lookback_days)
    planned = rows.join(known, ["table_name", "cursor_col"], "left").withColumn("start", begin).collect()
    return {r.table_name: TablePlan(r.table_name, r.start, end, r.cutoff, r.cursor) for r in planned}


def takes_codes(spec: TableSpec) -> bool:
    """Whether a list of instruments restricts this table."""
    return spec.by_instrument and "ts_code" in spec.schema.names


@dataclass(frozen=True)
class Landed:
    """What lies in the folders of a table whose rows come from several feeds, compared with the last run.

    ``files`` is what is there now; ``loaded_until`` is the last day up to which the known ones were loaded, and
    ``fresh`` names the files that are new or rewritten since.
    """

    files: DataFrame
    fresh: DataFrame
    loaded_until: date | None


def loaded_files(lake: Lake, spec: TableSpec) -> LakeTable:
    """Landed files of a table with several feeds, and the day up to which their rows are loaded."""
    return LakeTable(lake.spark, f"{lake.root}/{spec.name}_files", f"{FILES}, loaded_until date")


def landed_since(lake: Lake, spec: TableSpec, floor: date, end: date) -> Landed:
    """The files of all feeds of a table, in day folders within [floor, end] and outside of day folders."""
    listed = [list_files(lake.spark, f"{lake.landing}/{feed}", floor, end) for feed in spec.landed()]
    files = reduce(DataFrame.union, listed)
    known = loaded_files(lake, spec).rows()
    fresh = state.pending_units(files, known, ["path", "length", "modified"]).select("path")
    return Landed(files, fresh, known.agg(F.min("loaded_until")).first()[0])


def days_to_merge(lake: Lake, spec: TableSpec, landed: Landed, floor: date, end: date) -> list[date] | None:
    """Days in [floor, end] that were not loaded yet, or of which any feed has rows in a fresh file; None for all.

    There is at most one per date, so the driver can hold them.
    """
    if landed.loaded_until is None:
        return None
    days = cal_ops.open_days(lake.calendar(), spec.exchange, landed.loaded_until + timedelta(days=1), end).select(F.col("cal_date").alias("_merge_day"))
    if not landed.fresh.isEmpty():
        for raw in landed_feeds(lake, spec, floor, end):
            new = raw.withColumn("path", file_name(F.col(f"{LANDING_ORDER}.file"))).join(landed.fresh, "path", "left_semi")
            days = days.union(cleaning.clean(new, spec).select(F.col(spec.cursor)))
    inside = days.where(F.col("_merge_day").between(F.lit(floor), F.lit(end)))
    return sorted(r[0] for r in inside.distinct().collect())


def record_files(lake: Lake, spec: TableSpec, landed: Landed, end: date) -> None:
    """Remember what was read: rows up to ``end``, or to the last day that the calendar knows, are loaded."""
    until = lake.calendar().agg(F.least(F.max("cal_date"), F.lit(end))).first()[0]
    table = loaded_files(lake, spec)
    at = table.snapshot()
    table.replace(landed.files.withColumn("loaded_until", F.lit(until).cast("date")).coalesce(1), [""], at)


def _wanted(raw: DataFrame, lake: Lake, spec: TableSpec, first: date, last: date) -> DataFrame:
    """Accepted values, and the date range where the landed column is a date already."""
    for column, values in lake.accepted(spec).items():
        if column in raw.columns:
            raw = raw.where(F.col(column).isNull() | F.col(column).isin(*values))
    if spec.cursor in raw.columns and isinstance(raw.schema[spec.cursor].dataType, T.DateType):
        raw = raw.where(F.col(spec.cursor).between(F.lit(first), F.lit(last)))
    return raw


def landed_feeds(lake: Lake, spec: TableSpec, start: date, end: date, vendor_columns: bool = False) -> list[DataFrame]:
    """Raw rows of a table's feeds that have landed, accepted values only.

    ``vendor_columns`` also reads JSON columns that the specification names for no feed; other formats carry them anyway.
    """
    named = T.StructType([*spec.schema.fields, *(f for schema in spec.landed().values() for f in schema)])
    first = start.replace(day=1) if spec.from_month_start else start
    feeds = []
    for feed, schema in spec.landed().items():
        folders = (start, end) if spec.by_open_day else (None, None)
        if vendor_columns and lake.fmt == "json":
            new = added_columns(lake.spark, lake.landing, feed, named, *folders)
            schema = T.StructType([*schema.fields, *new.fields])
        raw = landed_or_none(
            lake.spark, lake.landing, feed, schema, lake.fmt, *folders, where=lambda df: _wanted(df, lake, spec, first, end)
        )
        if raw is not None:
            feeds.append(raw.drop(*[c for c, _ in spec.only if c not in spec.schema.names]))
    return feeds


def read_batch(
    lake: Lake, spec: TableSpec, start: date, end: date, codes: DataFrame | None = None, days: Sequence[date] | None = None
) -> DataFrame | None:
    """Cleaned rows of a table's landed feeds within [start, end]; None when nothing ever landed.

    ``days`` restricts them to some days.
    """
    first = start.replace(day=1) if spec.from_month_start else start
    feeds = []
    for raw in landed_feeds(lake, spec, start, end, vendor_columns=True):
        new_dates = [n for n in raw.columns if n.endswith("_date") and n not in (*spec.schema.names, *spec.dates)]
        rows = cleaning.normalize_dates(cleaning.clean(raw, spec), new_dates)
        if spec.cursor:
            # a day in the range is not null; one comparison, as Spark parses the landed text for each
            span = (end - first).days
            rows = rows.where(F.abs(2 * F.datediff(F.col(spec.cursor), F.lit(first)) - span) <= span)
        others = [k for k in spec.keys if k != spec.cursor]
        rows = cleaning.drop_null_keys(rows, others) if others else rows
        if spec.by_open_day:
            rows = cal_ops.on_open_days(rows, lake.calendar(), F.col(spec.cursor), spec.exchange)
        if codes is not None and takes_codes(spec):
            rows = cleaning.only_codes(rows, codes)
        if days is not None:
            wanted = local_frame(lake.spark, [(d,) for d in days], "_merge_day date")
            rows = rows.join(F.broadcast(wanted), F.col(spec.cursor) == F.col("_merge_day"), "left_semi")  # one row per date
        feeds.append(rows)
    if len(feeds) == 2:
        return merge.merge_feeds(*feeds, spec.keys, spec.cursor, order=(LANDING_ORDER,), null_safe=False)
    return feeds[0] if feeds else None


def count_losses(lake: Lake, spec: TableSpec, start: date, end: date) -> tuple[int, int, int]:
    """Landed rows that lack a part of their key, rows with a number that is not finite (stored as NULL), and files
    of exactly one full page, whose next page may not have landed."""
    dropped = infinite = truncated = 0
    floating = [f.name for f in spec.schema if isinstance(f.dataType, T.DoubleType)]
    for raw in landed_feeds(lake, spec, start, end):
        rows = cleaning.clean(raw, spec)
        present = [c for c in floating if c in raw.columns]
        missing = reduce(or_, [F.col(k).isNull() for k in spec.keys])
        texts = [F.lower(F.trim(F.col(f"`{c}`").cast("string"))).isin(*NOT_FINITE) for c in present]
        counts = rows.agg(F.count_if(missing)).first()[0], raw.agg(F.count_if(reduce(or_, texts, F.lit(False)))).first()[0]
        files = raw.groupBy(F.col(f"{LANDING_ORDER}.file").alias("file")).agg(F.count(F.lit(1)).alias("n"))
        full = files.where(F.col("n") == windows.PAGE_ROWS).count()
        dropped, infinite, truncated = dropped + counts[0], infinite + counts[1], truncated + full
    return dropped, infinite, truncated


def affected(changes: dict[str, int], mode: str) -> int:
    """One per inserted row, two per replaced one, none for rows that stay as they are."""
    return changes.get("inserted", 0) + (2 * changes.get("updated", 0) if mode == "upsert" else 0)


@dataclass(frozen=True)
class WriteResult:
    fetched: int
    inserted: int
    newest: date | None
    added: tuple[str, ...] = ()
    inserted_by_part: dict[str, int] = field(default_factory=dict)
    changes: dict[str, int] | None = None


def write_batch(
    table: LakeTable, spec: TableSpec, batch: DataFrame, mode: str, newest: Column | None = None, count_changes: bool = False
) -> WriteResult:
    """Merge a batch into the partitions it touches; untouched partitions are neither read nor written."""
    batch = with_partitions(batch, spec)
    measures = [F.count(F.lit(1)).alias("n"), (F.max(newest) if newest is not None else F.lit(None)).alias("newest")]
    stats = batch.groupBy(table.part_column().alias("part")).agg(*measures).collect()
    if not stats:
        return WriteResult(0, 0, None, changes={} if count_changes else None)
    parts = [r.part for r in stats]
    at = table.snapshot()
    order = (LANDING_ORDER,) if LANDING_ORDER in batch.columns else ()
    changes = None
    if count_changes:
        summary = merge.change_summary(table.read(parts, at).drop(*spec.partition_by), batch.drop(*spec.partition_by), spec.keys, order)
        changes = {r.change: r.n for r in summary.groupBy("change").agg(F.count(F.lit(1)).alias("n")).collect()}
    merged = merge.write_mode(mode)(table.read(parts, at), batch, spec.keys, order)
    after = table.replace(merged, parts, at)
    before = {p.part: p.n_rows for p in at.parts}
    inserted = {p: after.get(p, 0) - before.get(p, 0) for p in parts}
    added = tuple(c for c in batch.columns if c not in (*at.schema.names, *spec.partition_by, LANDING_ORDER))
    days = [r.newest for r in stats if r.newest is not None]
    return WriteResult(sum(r.n for r in stats), sum(inserted.values()), max(days, default=None), added, inserted, changes)


def apply_retention(table: LakeTable, day: Column, cutoff: date) -> int:
    """Drop whole months (or days) before the cutoff; rewrite its own month. Returns the rows removed."""
    at = table.snapshot()
    labels = {p.part: p.part.split("/")[0].split("=")[1] for p in at.parts}
    dated = {p: label for p, label in labels.items() if label[:4].isdigit()}  # rows without a date stay
    removed = 0
    boundary = [p for p, label in dated.items() if label == cutoff.strftime("%Y-%m")]
    if boundary:
        rows = table.read(boundary, at)
        if not rows.where(day < F.lit(cutoff)).isEmpty():
            left = table.replace(retention.keep_recent(rows, day, cutoff), boundary, at)
            removed += at.n_rows(boundary) - sum(left.values())
    return removed + table.drop([p for p, label in dated.items() if label < cutoff.isoformat()[: len(label)]])


def next_cursor(plan: TablePlan, result: WriteResult) -> date | None:
    """The rule of ``state.advance_cursor`` for one table: the newest day with data, never back."""
    reached = result.newest or (plan.end if result.fetched else plan.cursor)
    return max((d for d in (reached, plan.cursor) if d), default=None)


def update_table(
    lake: Lake,
    spec: TableSpec,
    plan: TablePlan,
    now: datetime,
    codes: DataFrame | None = None,
    write_mode: str = "upsert",
    no_delete: bool = False,
    count_changes: bool = False,
    by_files: bool = False,
) -> TableReport:
    """Bring one table up to date according to its plan.

    A run restricted to some codes writes their rows and leaves the cursor, so the others still load. A table
    whose rows come from several feeds is decided by files, since its feeds land at different times and a day
    is only right once all of them are merged: days with a row in a file that is new or rewritten, in whichever feed and
    however old, are merged again from all feeds. Its cursor only tells the newest day and where a first run starts.
    An explicit start or a look-back reads its whole range, as for other tables, and leaves the files as they are.
    """
    partial = codes is not None and takes_codes(spec)
    by_files = by_files and not partial and spec.by_open_day and len(spec.landed()) > 1
    report = TableReport(
        spec.name, plan.start.isoformat(), plan.end.isoformat(), cursor_col=spec.cursor,
        retention_cutoff=plan.cutoff.isoformat() if plan.cutoff else None,
    )
    table = lake.table(spec)
    start, days, landed = plan.start, None, None
    if by_files:
        floor = plan.cutoff or plan.end - timedelta(days=state.FIRST_RUN_DAYS)
        landed = landed_since(lake, spec, floor, plan.end)
        days = days_to_merge(lake, spec, landed, floor, plan.end)
        # rows of a day land on it or later, so folders before the first day to merge are not needed
        start = floor if days is None else days[0] if days else plan.end
        report.start = start.isoformat()
    batch = read_batch(lake, spec, start, plan.end, codes, days)
    result = WriteResult(0, 0, None)
    if batch is not None:
        newest = F.col(spec.cursor) if spec.cursor else None
        with staged(batch, spec.name) as rows:
            result = write_batch(table, spec, rows, write_mode, newest, count_changes)
    if landed is not None and batch is not None:
        record_files(lake, spec, landed, plan.end)
    report.rows_fetched, report.rows_inserted, report.added_columns = result.fetched, result.inserted, result.added
    if count_changes:
        seen = result.changes or {}
        ignored = write_mode == "ignore"  # which leaves what is stored
        report.rows_updated = 0 if ignored else seen.get("updated", 0)
        report.rows_unchanged = seen.get("unchanged", 0) + (seen.get("updated", 0) if ignored else 0)
        report.rows_affected = affected(seen, write_mode)
        report.rows_dropped, report.rows_not_finite, report.pages_truncated = count_losses(lake, spec, start, plan.end)
    if spec.cursor:
        following = plan.cursor if partial else next_cursor(plan, result)
        report.cursor_value = following.isoformat() if following else None
        if following is not None and following != plan.cursor:
            lake.save_cursors([(MASTER, spec.name, spec.cursor, report.cursor_value)], now)
    if plan.cutoff and not no_delete and table.exists():
        report.rows_deleted = apply_retention(table, F.col(spec.day), plan.cutoff)
    return report


def _known(names: Sequence[str]) -> list[TableSpec]:
    unknown = [n for n in names if n not in SPECS or SPECS[n] is BARS]
    if unknown:
        raise ValueError(f"unknown daily tables: {unknown}")
    return [SPECS[n] for n in names]


@in_short_methods
def update(
    lake: Lake,
    tables: Sequence[str],
    end: date,
    now: datetime,
    start: date | None = None,
    lookback_days: int = 0,
    codes: DataFrame | None = None,
    write_mode: str = "upsert",
    no_delete: bool = False,
    keep_open_days: int = 0,
    count_changes: bool = False,
) -> list[TableReport]:
    """Update several tables, the calendar first and long enough for every retention window.

    ``count_changes`` fills the reports' counts of updated, unchanged and dropped rows, which takes another pass.
    ``keep_open_days`` is a window that later steps need, if wider than those of ``tables``.
    """
    ordered = _known(update_order(list(tables)))
    depth = calendar_years(max(keep_open_days, *((s.keep_open_days or 0) for s in ordered)))
    earliest = end - timedelta(days=365 * depth)
    cal_start = earliest if start is None else min(start, earliest)
    plan = plan_tables(lake, ordered[:1], end, cal_start, lookback_days, no_delete)
    reports = [update_table(lake, ordered[0], plan["trade_cal"], now, None, write_mode, no_delete, count_changes)]
    rest = ordered[1:]
    plans = plan_tables(lake, rest, end, start, lookback_days, no_delete) if rest else {}
    for spec in rest:
        by_files = start is None and not lookback_days
        reports.append(update_table(lake, spec, plans[spec.name], now, codes, write_mode, no_delete, count_changes, by_files))
    return reports


def month_batches(spark: SparkSession, start: date, end: date) -> list[tuple[date, date]]:
    """Clamped calendar months of [start, end], the batches of a backfill."""
    one = local_frame(spark, [(start, end)], "s date, e date")
    rows = windows.month_windows(one, F.col("s"), F.col("e"), clamp=True).orderBy("window_start")
    return [(r.window_start, r.window_end) for r in rows.collect()]


@in_short_methods
def backfill_master(
    lake: Lake,
    end: date,
    now: datetime,
    keep_open_days: int = 500,
    tables: Sequence[str] | None = None,
    write_mode: str = "upsert",
    months_per_batch: int = 0,
) -> list[TableReport]:
    """Fill the last ``keep_open_days`` open days, then enforce retention once.

    Every feed is read once and written to all its months together, as the month is the partition that a
    merge rewrites. With ``months_per_batch``, tables landed by open day, whose folders a narrower range
    prunes, go in batches of that many months, so that a stopped run repeats less. Each table is cut by its own window
    and date column, and a calendar too short for one of them is an error.
    """
    names = backfill_order(list(tables) if tables is not None else [s for s in SPECS if s != BARS.name])
    widest = max([keep_open_days, *((s.keep_open_days or 0) for s in _known(names))])
    reports = update(
        lake, ["trade_cal", "stock_basic"], end, now, write_mode=write_mode, no_delete=True, keep_open_days=widest
    )
    cutoff = retention_cutoff(lake, keep_open_days, end, "SSE")
    own_cutoffs = {
        name: retention_cutoff(lake, SPECS[name].keep_open_days, end, SPECS[name].exchange)
        for name in names
        if SPECS[name].keep_open_days
    }
    months = month_batches(lake.spark, cutoff, end) if months_per_batch else []
    batches = [
        (months[i][0], months[min(i + months_per_batch, len(months)) - 1][1])
        for i in range(0, len(months), months_per_batch or 1)
    ]
    for name in names:
        spec = SPECS[name]
        for first, last in batches if batches and spec.by_open_day else [(cutoff, end)]:
            plan = plan_tables(lake, [spec], last, first, no_delete=True)[name]
            reports.append(update_table(lake, spec, plan, now, None, write_mode, no_delete=True))
    for name, own in own_cutoffs.items():
        table = lake.table(SPECS[name])
        if table.exists():
            removed = apply_retention(table, F.col(SPECS[name].day), own)
            reports.append(TableReport(name, cutoff.isoformat(), end.isoformat(), rows_deleted=removed, retention_cutoff=own.isoformat()))
    return reports


def report_frame(spark: SparkSession, reports: Sequence[TableReport]) -> DataFrame:
    """Reports as rows, one per table and batch."""
    ddl = (
        "`table` string, start string, end string, rows_fetched bigint, rows_inserted bigint, rows_deleted bigint, "
        "cursor_col string, cursor_value string, retention_cutoff string, added_columns array<string>, "
        "rows_updated bigint, rows_unchanged bigint, rows_dropped bigint, rows_not_finite bigint, rows_affected bigint, "
        "pages_truncated bigint"
    )
    return local_frame(spark, [astuple(r) for r in reports], ddl)
