"""Intraday bars: incremental update and resumable full-market backfill, all shards in one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.codes import SHARDS
from ..functions.dates import in_session
from ..operators import calendar as cal_ops, cleaning, quality, state
from ..session import in_short_methods, local_frame, staged
from ..sources import bars_csv
from ..sources.lake import LakeTable
from ..sources.landed import LANDED_DAY, file_name, list_files
from .specs import BARS, SPECS
from .update import Lake, affected, apply_retention, retention_cutoff, write_batch

FEED = BARS.name


@dataclass(frozen=True)
class BarsReport:
    end: date
    cutoff: date | None
    rows_fetched: int
    rows_inserted: int
    rows_deleted: int
    cursors: dict[str, date | None]
    inserted_by_shard: dict[str, int]
    # only counted on request: rows that lack a part of their key, that fall outside of sessions, open days or the
    # window, that changed a stored row, that equal it, and the count a server would report as affected
    rows_dropped: int | None = None
    rows_outside: int | None = None
    rows_updated: int | None = None
    rows_unchanged: int | None = None
    rows_affected: int | None = None


def resolve_end(lake: Lake, end: date | None, now: datetime) -> date:
    """Explicit end, or the last session finished by ``now``."""
    if end is not None:
        return end
    one = local_frame(lake.spark, [(now.date(), now)], "end_day date, now timestamp_ntz")
    return cal_ops.last_completed_day(one, lake.calendar(), F.col("end_day"), F.col("now")).first().done_day


def shard_cursors(lake: Lake) -> dict[str, date | None]:
    """Cursor of each shard (three rows)."""
    known = lake.cursors(BARS.cursor).where(F.col("table_name") == BARS.name)
    rows = known.select("cluster", state.cursor_date(F.col("cursor_value")).alias("day")).collect()
    return {s: None for s in SHARDS} | {r.cluster: r.day for r in rows}


def by_shard(values: dict[str, date | None], shard: Column) -> Column:
    """A per-shard constant as a column expression."""
    picked = F.lit(None).cast("date")
    for name, value in values.items():
        picked = F.when(shard == name, F.lit(value)).otherwise(picked)
    return picked


def landed_path(lake: Lake) -> str:
    return f"{lake.landing}/{FEED}"


def parse_landed(lake: Lake, days: Sequence[str] | None = None) -> DataFrame:
    """Landed bars, parsed file by file and routed to shards."""
    raw = bars_csv.read_bars_csv(lake.spark, landed_path(lake), days=days)
    return cleaning.with_shard(cleaning.clean_bars(raw, BARS, bars_csv.SOURCE_FILE))


def usable(rows: DataFrame, cal: DataFrame, starts: dict[str, date], ends: dict[str, date]) -> DataFrame:
    """Bars with complete keys, inside a session of an open day, between the shard's start and end."""
    day = F.col("trade_time").cast("date")
    # constant bounds reach the scan; the shards' own then apply within them
    first = F.lit(min(starts.values())).cast("timestamp_ntz")
    rows = cleaning.drop_null_keys(rows, BARS.keys).where(F.col("trade_time") >= first)
    inside = (day >= by_shard(starts, F.col("shard"))) & (day <= by_shard(ends, F.col("shard")))
    return cal_ops.on_open_days(rows.where(in_session(F.col("trade_time")) & inside), cal, day)


def done_files(lake: Lake) -> LakeTable:
    """Landed files that are loaded: path, length and modification time, per day folder."""
    return LakeTable(lake.spark, f"{lake.root}/{BARS.name}_done", "path string, length bigint, modified bigint", (LANDED_DAY,))


def pending_days(lake: Lake, listed: DataFrame) -> list[str]:
    """Day folders with a file that is new or rewritten since it was loaded; "" stands for files outside of folders.

    What to read is decided by files, not by cursors: a file that lands late, for whatever day of the window,
    is loaded by the next run. The list is bounded by the calendar.
    """
    done = done_files(lake)
    if done.exists():
        listed = state.pending_units(listed, done.read(), ["path", "length", "modified"])
    return sorted(r[LANDED_DAY] for r in listed.select(LANDED_DAY).distinct().collect())


def _load(
    lake: Lake,
    days: list[str],
    starts: dict[str, date],
    ends: dict[str, date],
    write_mode: str,
    codes: DataFrame | None,
    listed: DataFrame | None,
    count_changes: bool = False,
) -> tuple[int, dict[str, int], dict[str, date], dict[str, int]]:
    """Load whole day folders; (rows fetched, inserted per shard, newest day per shard, counts on request).

    The files of ``listed`` are recorded as done, except those with rows that a later run may want: on days
    after the shard's end, or that the calendar does not know yet. A file outside a day folder is never done.
    """
    if not days:
        return 0, {s: 0 for s in SHARDS}, {}, {}
    counts: dict[str, int] = {}
    cal = lake.calendar()
    # text is parsed once, into the staged rows; every filter then works on typed columns
    with staged(parse_landed(lake, days), BARS.name) as parsed:
        batch = usable(parsed, cal, starts, ends).drop(bars_csv.SOURCE_FILE)
        if count_changes:
            keyless = F.count_if(F.col("ts_code").isNull() | F.col("trade_time").isNull())
            every = parsed.agg(F.count(F.lit(1)).alias("n"), keyless.alias("dropped")).first()
            counts = {"rows_dropped": every.dropped, "rows_outside": every.n - every.dropped - batch.count()}
        if codes is not None:
            batch = cleaning.only_codes(batch, codes)
        day = F.col("trade_time").cast("date")
        newest = {r.shard: r.day for r in batch.groupBy("shard").agg(F.max(day).alias("day")).collect()}
        result = write_batch(lake.table(BARS), BARS, batch, write_mode, count_changes=count_changes)
        if count_changes:
            seen = result.changes or {}
            replaced = seen.get("updated", 0) if write_mode == "upsert" else 0
            kept = seen.get("unchanged", 0) + seen.get("updated", 0) - replaced
            counts |= {"rows_updated": replaced, "rows_unchanged": kept, "rows_affected": affected(seen, write_mode)}
        if listed is not None:
            dated = parsed.where(F.col("trade_time").isNotNull()).withColumn("_day", day)
            known = cal.select(F.col("cal_date").alias("_day")).distinct()
            later = dated.where(F.col("_day") > by_shard(ends, F.col("shard")))
            wanted = later.select(bars_csv.SOURCE_FILE).union(
                dated.join(known, "_day", "left_anti").select(bars_csv.SOURCE_FILE)
            )
            open_files = wanted.select(file_name(F.col(bars_csv.SOURCE_FILE)).alias("path")).distinct()
            read = listed.where(F.col(LANDED_DAY).isin(*days) & (F.col(LANDED_DAY) != ""))
            folders = [f"{LANDED_DAY}={d}" for d in days if d]
            if folders:
                done_files(lake).replace(read.join(open_files, "path", "left_anti"), folders)
    inserted = {s: sum(n for p, n in result.inserted_by_part.items() if p.endswith(f"shard={s}")) for s in SHARDS}
    return result.fetched, inserted, newest, counts


def _move_cursors(lake: Lake, cursors: dict[str, date | None], reached: dict[str, date], now: datetime) -> dict[str, date | None]:
    """Never back; only changes are stored."""
    moved = {s: max((d for d in (cursors[s], reached.get(s)) if d), default=None) for s in SHARDS}
    changed = [(s, BARS.name, BARS.cursor, d.isoformat()) for s, d in moved.items() if d and d != cursors[s]]
    lake.save_cursors(changed, now)
    return moved


@in_short_methods
def update_bars(
    lake: Lake,
    now: datetime,
    end: date | None = None,
    start: date | None = None,
    codes: DataFrame | None = None,
    lookback_days: int = 0,
    keep_open_days: int = 250,
    write_mode: str = "upsert",
    no_delete: bool = False,
    count_changes: bool = False,
) -> BarsReport:
    """Load the files that are new or rewritten since the last run, and enforce retention.

    An explicit start or a look-back reads all files of its range again. The cursor is the newest day with
    data; it only sets where a first run without retention starts. A run restricted to some codes reads all
    files of its range, records none of them and leaves the cursors. ``count_changes`` fills the report's counts, which
    takes another pass.
    """
    last = resolve_end(lake, end, now)
    cutoff = None if no_delete else retention_cutoff(lake, keep_open_days, last, BARS.exchange)
    cursors = shard_cursors(lake)
    known = [c for c in cursors.values() if c]
    # without a cutoff a first run starts at the end day, and later ones at the first day ever recorded
    floor = cutoff or (_first_recorded(lake) or min(known) if known else last)
    begin = max(floor, start) if start and cutoff else start or floor
    if lookback_days:
        begin = max(min(begin, last - timedelta(days=2 * lookback_days)), cutoff or date.min)
    listed = list_files(lake.spark, landed_path(lake), begin, last, "*.csv*")
    again = start is not None or lookback_days > 0 or codes is not None
    days = sorted(r[0] for r in listed.select(LANDED_DAY).distinct().collect()) if again else pending_days(lake, listed)
    starts, ends = {s: begin for s in SHARDS}, {s: last for s in SHARDS}
    complete = codes is None and begin <= floor
    recorded = listed if complete else None
    fetched, inserted, newest, counts = _load(lake, days, starts, ends, write_mode, codes, recorded, count_changes)
    moved = cursors if codes is not None else _move_cursors(lake, cursors, newest, now)
    deleted = _retain(lake.table(BARS), cutoff)
    return BarsReport(last, cutoff, fetched, sum(inserted.values()), deleted, moved, inserted, **counts)


def _first_recorded(lake: Lake) -> date | None:
    days = [p.part.split("=")[1] for p in done_files(lake).snapshot().parts]
    return datetime.strptime(min(days), "%Y%m%d").date() if days else None


def _retain(table: LakeTable, cutoff: date | None) -> int:
    if cutoff is None or not table.exists():
        return 0
    return apply_retention(table, F.col("trade_time").cast("date"), cutoff)


def newest_complete_days(
    lake: Lake, universe: DataFrame, share: float = 1.0, first: date | None = None, last: date | None = None
) -> dict[str, date]:
    """Newest day per shard on which at least ``share`` of the codes expected to trade have bars.

    Codes suspended on a day are not expected. ``first`` and ``last`` prune the stored day partitions.
    """
    table = lake.table(BARS)
    stored = table.read([p.part for p in table.snapshot().parts if _within(p.part, first, last)])
    members = cleaning.with_shard(universe.select("ts_code").distinct())
    traded = stored.select(F.col("trade_time").cast("date").alias("day"), "ts_code").distinct()
    settled = traded
    halts = lake.table(SPECS["suspend_d"])
    if halts.exists():
        halted = halts.rows().where("suspend_type = 'S'").select(F.col("trade_date").alias("day"), "ts_code")
        # a day without any bars is not complete, however many codes are suspended
        settled = traded.union(halted.join(traded.select("day").distinct(), "day", "left_semi")).distinct()
    expected = members.groupBy("shard").agg(F.count(F.lit(1)).alias("expected"))
    per_day = settled.join(members, "ts_code").groupBy("shard", "day").agg(F.count(F.lit(1)).alias("n_codes"))
    complete = per_day.join(expected, "shard").where(F.col("n_codes") >= F.col("expected") * share)
    return {r.shard: r.day for r in complete.groupBy("shard").agg(F.max("day").alias("day")).collect()}


def _within(part: str, first: date | None, last: date | None) -> bool:
    day = part.split("/")[0].split("=")[1]
    return (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat())


@in_short_methods
def backfill_bars(
    lake: Lake,
    now: datetime,
    end: date | None = None,
    keep_open_days: int = 250,
    write_mode: str = "ignore",
    resume: bool = False,
    reset_cursor: bool = False,
    max_codes: int = 0,
    max_days: int = 0,
    no_delete: bool = False,
    count_changes: bool = False,
) -> BarsReport:
    """Load the last ``keep_open_days`` open days of every instrument.

    With ``resume``, only day folders with new or rewritten files are read, whatever the cursors say, and the
    cursors move to the newest complete day. ``max_days`` ends each shard that many open days after its cursor.
    A controlled run with ``max_codes`` writes rows but neither moves cursors nor records files. Instruments
    that join the universe later need a run with ``reset_cursor``, which reads every file of the window.
    """
    last = resolve_end(lake, end, now)
    cutoff = retention_cutoff(lake, keep_open_days, last, BARS.exchange)
    universe = cleaning.universe(lake.table(SPECS["stock_basic"]).rows())
    chosen = universe.orderBy("ts_code").limit(max_codes) if max_codes else universe
    cursors = shard_cursors(lake)
    if reset_cursor and not max_codes:
        cursors = {s: cutoff - timedelta(days=1) for s in SHARDS}
        lake.save_cursors([(s, BARS.name, BARS.cursor, d.isoformat()) for s, d in cursors.items()], now)
    ends = {s: last for s in SHARDS}
    if max_days:
        open_days = cal_ops.open_days(lake.calendar(), BARS.exchange, cutoff, last).select("cal_date").distinct()
        ordered = sorted(r.cal_date for r in open_days.collect())  # at most keep_open_days of them
        for s in SHARDS:
            ahead = [d for d in ordered if not (resume and cursors[s]) or d > cursors[s]][:max_days]
            ends[s] = ahead[-1] if ahead else last
    listed = list_files(lake.spark, landed_path(lake), cutoff, max(ends.values()), "*.csv*")
    if resume and not reset_cursor:
        days = pending_days(lake, listed)
    else:
        days = sorted(r[LANDED_DAY] for r in listed.select(LANDED_DAY).distinct().collect())
    starts = {s: cutoff for s in SHARDS}
    recorded = None if max_codes else listed
    fetched, inserted, _, counts = _load(lake, days, starts, ends, write_mode, chosen, recorded, count_changes)
    if not max_codes and lake.table(BARS).exists():
        ahead_of = min((c for c in cursors.values() if c), default=cutoff)
        complete = newest_complete_days(lake, universe, first=max(cutoff, ahead_of), last=max(ends.values()))
        cursors = _move_cursors(lake, cursors, {s: min(d, ends[s]) for s, d in complete.items()}, now)
    deleted = 0 if no_delete else _retain(lake.table(BARS), cutoff)
    return BarsReport(last, cutoff, fetched, sum(inserted.values()), deleted, cursors, inserted, **counts)


def audit_shards(lake: Lake) -> DataFrame:
    """Columns whose presence or type differs between the files of the stored shards, or that are text though numeric.

    Every revision's files have one schema, which is read from one of them; no rows are read. A shard whose live
    partitions were written with several schemas counts once for each.
    """
    table = lake.table(BARS)
    at = table.snapshot()
    schemas: dict[str, T.StructType] = {}
    found: dict[str, dict[str, T.StructType]] = {s: {} for s in SHARDS}
    for part in at.parts:
        shard = part.part.split("shard=")[1]
        if part.folder not in schemas:
            schemas[part.folder] = lake.spark.read.parquet(f"{table.path}/data/{part.folder}/{part.part}").schema
        found.setdefault(shard, {})[schemas[part.folder].simpleString()] = schemas[part.folder]
    frames = {}
    for shard, kinds in found.items():
        for i, schema in enumerate(kinds.values()):
            frames[f"{shard}#{i + 1}" if len(kinds) > 1 else shard] = lake.spark.createDataFrame([], schema)
    if not frames:
        frames = {"none": lake.spark.createDataFrame([], BARS.schema)}
    numeric = [f.name for f in BARS.schema if isinstance(f.dataType, T.NumericType)]
    return quality.schema_drift(frames, numeric)
