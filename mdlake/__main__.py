"""Command line: ``python -m mdlake <command>``; reports are printed as JSON."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import asdict
from datetime import date, datetime
import json

from pyspark.sql import DataFrame

from .operators import cleaning, ranking
from .plans import bars, repair, update as jobs
from .plans.specs import DAILY_SPECS, SPECS
from .session import build_session, local_frame
from .sources.landed import read_codes


def _names(text: str) -> list[str]:
    return [part.strip() for part in text.split(",") if part.strip()]


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="mdlake")
    parser.add_argument("--lake", required=True, help="folder of the maintained tables")
    parser.add_argument("--landing", required=True, help="folder of the landed extracts")
    parser.add_argument("--format", default="json", help="file format of the landed extracts")
    parser.add_argument("--index-codes", default="", help="indices whose weights are loaded")
    parser.add_argument("--master", default=None, help="Spark master, unless set by spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=text)
        command.add_argument("--until", type=date.fromisoformat, default=None, help="last day (default: today)")
        command.add_argument("--write-mode", choices=["upsert", "ignore"], default=None)
        command.add_argument("--no-delete", action="store_true", help="skip retention")
        return command

    for name, text in (("update", "update daily tables"), ("update-bars", "update intraday bars")):
        command = add(name, text)
        command.add_argument("--since", type=date.fromisoformat, default=None)
        command.add_argument("--lookback-days", type=int, default=0, help="N re-reads 2N calendar days")
        command.add_argument("--codes", default="", help="comma-separated codes")
        command.add_argument("--codes-file", default="", help="one code per line")
        command.add_argument("--sample-codes", type=int, default=0, help="random sample of stored instruments")
    commands.choices["update"].add_argument("--tables", default="all")
    commands.choices["update"].add_argument("--count-changes", action="store_true", help="report updated and dropped rows")

    master = add("backfill-master", "fill the daily tables month by month")
    master.add_argument("--tables", default="all")
    master.add_argument("--keep-open-days", type=int, default=500)
    master.add_argument("--months-per-batch", type=int, default=0)

    full = add("backfill-bars", "fill the bars of every instrument")
    full.add_argument("--keep-open-days", type=int, default=250)
    full.add_argument("--no-resume", action="store_true")
    full.add_argument("--reset-cursor", action="store_true")
    full.add_argument("--max-codes", type=int, default=0)
    full.add_argument("--max-days", type=int, default=0)

    fix = commands.add_parser("repair", help="report and retype numeric columns stored as text")
    fix.add_argument("--table", required=True, choices=sorted(SPECS))
    fix.add_argument("--columns", default="", help="default: the numeric columns of the table's audit")
    fix.add_argument("--type", default=None)
    fix.add_argument("--apply", action="store_true", help="write (default: report only)")
    commands.add_parser("vacuum", help="delete table revisions that are no longer in force")
    return parser


def _codes(args: argparse.Namespace, lake: jobs.Lake) -> DataFrame | None:
    if args.codes:
        return local_frame(lake.spark, [(c,) for c in _names(args.codes)], "ts_code string")
    if args.codes_file:
        return read_codes(lake.spark, args.codes_file)
    if args.sample_codes:
        stored = cleaning.universe(lake.table(SPECS["stock_basic"]).rows())
        seed = int(datetime.now().timestamp())
        return ranking.sample_codes(stored, args.sample_codes, seed)
    return None


def run(args: argparse.Namespace, lake: jobs.Lake, now: datetime) -> object:
    if args.command == "update":
        tables = [s.name for s in DAILY_SPECS] if args.tables == "all" else _names(args.tables)
        reports = jobs.update(
            lake, tables, args.until or now.date(), now, args.since, args.lookback_days, _codes(args, lake),
            args.write_mode or "upsert", args.no_delete, count_changes=args.count_changes,
        )
        return [asdict(r) for r in reports]
    if args.command == "update-bars":
        codes = _codes(args, lake)
        if codes is None:
            raise SystemExit("name codes with --codes, --codes-file or --sample-codes")
        report = bars.update_bars(
            lake, now, args.until, args.since, codes, args.lookback_days, write_mode=args.write_mode or "upsert",
            no_delete=args.no_delete,
        )
        return asdict(report)
    if args.command == "backfill-master":
        tables = None if args.tables == "all" else _names(args.tables)
        reports = jobs.backfill_master(
            lake, args.until or now.date(), now, args.keep_open_days, tables, args.write_mode or "upsert", args.months_per_batch
        )
        return [asdict(r) for r in reports]
    if args.command == "backfill-bars":
        report = bars.backfill_bars(
            lake, now, args.until, args.keep_open_days, args.write_mode or "ignore", not args.no_resume,
            args.reset_cursor, args.max_codes, args.max_days, args.no_delete,
        )
        return asdict(report)
    if args.command == "vacuum":
        return {name: lake.table(spec).vacuum() for name, spec in SPECS.items()}
    is_bars = args.table == bars.BARS.name
    columns = _names(args.columns) or list(repair.NUMERIC_BARS if is_bars else repair.NUMERIC_FLOW)
    target = args.type or ("double" if is_bars else "decimal(24,2)")
    return asdict(repair.repair_table(lake.table(SPECS[args.table]), columns, target, args.apply))


def main(argv: Sequence[str] | None = None, now: datetime | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session("mdlake", args.master)
    lake = jobs.Lake(spark, args.lake, args.landing, args.format, _names(args.index_codes))
    print(json.dumps(run(args, lake, now or datetime.now()), default=str, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
