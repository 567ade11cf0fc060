"""Tables on disk and whole jobs: restart, retention, evolution, late files, streams."""

from __future__ import annotations

from datetime import date, datetime, timedelta
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from mdlake import session
from mdlake.__main__ import main
from mdlake.operators import quality, reshape
from mdlake.plans import bars as bar_jobs, update as jobs
from mdlake.plans.specs import ALL_SPECS, BARS, SPECS, STATE_SCHEMA, TableSpec, backfill_order, calendar_years, update_order
from mdlake.plans.repair import repair_table
from mdlake.sources.bars_csv import read_bars_csv
from mdlake.sources.lake import LakeTable, StaleSnapshot
from mdlake.sources.landed import json_columns, quarantined, read_landed
from mdlake.streaming.ingest import ingest, landed_stream

NOW = datetime(2024, 12, 31, 16)
END = date(2024, 12, 31)


def land(root, feed, rows, day=None, name="a"):
    folder = f"{root}/{feed}" + (f"/landed_day={day}" if day else "")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in rows)


def land_bars(root, name, header, lines, day=None):
    folder = f"{root}/minute_5m" + (f"/landed_day={day}" if day else "")
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}.csv.gz", "wt") as out:
        out.write("\n".join([header, *lines]) + "\n" if header else "")


def land_calendar(root, start=date(2022, 6, 1), end=END):
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    land(root, "trade_cal", [{"exchange": "SSE", "cal_date": d.strftime("%Y%m%d"), "is_open": str(int(d.weekday() < 5))} for d in days])


@pytest.fixture()
def lake(spark, tmp_path):
    land_calendar(f"{tmp_path}/in")
    return jobs.Lake(spark, f"{tmp_path}/tables", f"{tmp_path}/in")


def content(table, *columns):
    return sorted(tuple(r) for r in table.rows().select(*columns).collect())


def test_daily_update_then_restart(lake):
    base = {"ts_code": "000001.SZ", "trade_date": "20240105", "vol": "10", "amount": "5"}
    land(lake.landing, "daily", [base | {"close": 1}, base | {"close": 2}, base | {"trade_date": "20240106", "close": 3}], "20240105")
    land(lake.landing, "daily_basic", [base | {"close": 9, "pe": "0.5"}, {"ts_code": "000002.SZ", "trade_date": "20240105", "close": 8, "pe": "x"}], "20240105")
    first = {r.table: r for r in jobs.update(lake, ["daily_raw"], END, NOW)}
    expected = [("000001.SZ", date(2024, 1, 5), 2.0, 5000.0, 1000.0), ("000002.SZ", date(2024, 1, 5), None, None, None)]
    columns = ("ts_code", "trade_date", "close", "amount", "vol_share")
    assert content(lake.table(SPECS["daily_raw"]), *columns) == expected
    assert first["daily_raw"].cursor_value == "2024-01-05" and first["daily_raw"].rows_inserted == 2
    again = {r.table: r for r in jobs.update(lake, ["daily_raw"], END, NOW, start=date(2024, 1, 1))}
    assert again["daily_raw"].rows_inserted == 0 and again["daily_raw"].cursor_value == "2024-01-05"
    assert content(lake.table(SPECS["daily_raw"]), *columns) == expected


def daily_rows(lake):
    return content(lake.table(SPECS["daily_raw"]), "ts_code", "trade_date", "close", "pe")


@pytest.mark.parametrize("folders", [True, False])
@pytest.mark.parametrize("first", ["daily", "daily_basic"])
def test_feeds_of_a_day_land_in_either_order(lake, first, folders):
    """Days 4 and 5: one feed of the 4th lands a run late, its partner and the 5th are loaded by then."""
    feeds = {
        "daily": [{"ts_code": c, "trade_date": "20240104", "close": p} for c, p in (("a.SZ", 5), ("b.SZ", 6))],
        "daily_basic": [{"ts_code": "a.SZ", "trade_date": "20240104", "close": 9, "pe": 1}],
    }
    late = "daily_basic" if first == "daily" else "daily"
    place = (lambda d: d) if folders else (lambda d: None)
    land(lake.landing, first, feeds[first], place("20240104"), "d4")
    for feed in feeds:
        land(lake.landing, feed, [{"ts_code": "a.SZ", "trade_date": "20240105", "close": 7, "pe": 2}], place("20240105"), "d5")
    jobs.update(lake, ["daily_raw"], END, NOW)
    land(lake.landing, late, feeds[late], place("20240104"), "d4")
    report = jobs.update(lake, ["daily_raw"], END, NOW)[-1]
    d4, d5 = date(2024, 1, 4), date(2024, 1, 5)
    assert daily_rows(lake) == [("a.SZ", d4, 5.0, 1.0), ("a.SZ", d5, 7.0, 2.0), ("b.SZ", d4, 6.0, None)]
    assert report.cursor_value == "2024-01-05" and report.rows_fetched == 2  # the 5th is not merged again
    assert jobs.update(lake, ["daily_raw"], END, NOW)[-1].rows_fetched == 0


def test_a_rewritten_feed_file_is_merged_with_its_partner(lake):
    land(lake.landing, "daily", [{"ts_code": "a.SZ", "trade_date": "20240104", "close": 5}], "20240104")
    land(lake.landing, "daily_basic", [{"ts_code": "a.SZ", "trade_date": "20240104", "pe": 1}], "20240104")
    jobs.update(lake, ["daily_raw"], END, NOW)
    land(lake.landing, "daily", [{"ts_code": "a.SZ", "trade_date": "20240104", "close": 55}], "20240104")
    jobs.update(lake, ["daily_raw"], END, NOW)
    assert daily_rows(lake) == [("a.SZ", date(2024, 1, 4), 55.0, 1.0)]


def test_a_file_that_lands_while_a_run_reads_is_left_for_the_next(lake, monkeypatch):
    row = {"ts_code": "a.SZ", "trade_date": "20240104", "close": 5}
    land(lake.landing, "daily", [row])
    write = jobs.write_batch

    def slow_write(*args, **kwargs):
        if args[1].name == "daily_raw":
            land(lake.landing, "daily", [row | {"ts_code": "b.SZ"}], name="late")
        return write(*args, **kwargs)

    monkeypatch.setattr(jobs, "write_batch", slow_write)
    jobs.update(lake, ["daily_raw"], END, NOW)
    monkeypatch.undo()
    jobs.update(lake, ["daily_raw"], END, NOW)
    assert [r[0] for r in daily_rows(lake)] == ["a.SZ", "b.SZ"]


def test_days_after_the_end_are_loaded_by_a_later_run(lake):
    rows = [{"ts_code": "a.SZ", "trade_date": d, "close": 1} for d in ("20241226", "20241227", "20241230")]
    land(lake.landing, "daily", rows)
    land(lake.landing, "daily_basic", [r | {"pe": 3} for r in rows])
    assert jobs.update(lake, ["daily_raw"], date(2024, 12, 26), NOW)[-1].rows_fetched == 1
    assert jobs.update(lake, ["daily_raw"], date(2024, 12, 27), NOW)[-1].rows_fetched == 1
    assert jobs.update(lake, ["daily_raw"], END, NOW)[-1].rows_fetched == 1
    assert [r[1].day for r in daily_rows(lake)] == [26, 27, 30]


def test_runs_of_a_range_or_of_some_codes_leave_the_files_to_load(spark, lake):
    rows = [{"ts_code": c, "trade_date": d, "close": 1} for c in ("a.SZ", "b.SZ") for d in ("20240104", "20240105")]
    land(lake.landing, "daily", rows)
    jobs.update(lake, ["daily_raw"], END, NOW, codes=spark.createDataFrame([("a.SZ",)], "ts_code string"))
    jobs.update(lake, ["daily_raw"], END, NOW, start=date(2024, 1, 5))
    assert len(daily_rows(lake)) == 3
    jobs.update(lake, ["daily_raw"], END, NOW)
    assert len(daily_rows(lake)) == 4


def test_a_new_vendor_column_reaches_the_table(lake):
    base = {"ts_code": "a.SZ", "trade_date": "20240104", "adj_factor": "1.5"}
    land(lake.landing, "adj_factor", [base], "20240104")
    assert jobs.update(lake, ["adj_factor"], END, NOW)[-1].added_columns == ()
    new = {"trade_date": "20240105", "grade": "x", "rank": 7, "share": 0.25, "listed_date": "19910403", "mixed": 1}
    land(lake.landing, "adj_factor", [base | new, base | new | {"ts_code": "b.SZ", "mixed": "one", "rank": None}], "20240105")
    report = jobs.update(lake, ["adj_factor"], END, NOW)[-1]
    assert sorted(report.added_columns) == ["grade", "listed_date", "mixed", "rank", "share"]
    columns = ("ts_code", "trade_date", "adj_factor", "grade", "rank", "share", "listed_date", "mixed")
    d4, d5, listed = date(2024, 1, 4), date(2024, 1, 5), date(1991, 4, 3)
    assert content(lake.table(SPECS["adj_factor"]), *columns) == [
        ("a.SZ", d4, 1.5, None, None, None, None, None),
        ("a.SZ", d5, 1.5, "x", 7, 0.25, listed, "1"),
        ("b.SZ", d5, 1.5, "x", None, 0.25, listed, "one"),
    ]


def test_columns_of_all_columnar_files_are_read(spark, tmp_path):
    one = spark.createDataFrame([("a.SZ", "20240104", "1")], "ts_code string, trade_date string, adj_factor string")
    one.write.parquet(f"{tmp_path}/adj_factor/landed_day=20240104")
    one.withColumn("grade", F.lit("x")).write.parquet(f"{tmp_path}/adj_factor/landed_day=20240105")
    raw = read_landed(spark, str(tmp_path), "adj_factor", one.schema, "parquet")
    assert {r["grade"] for r in raw.collect()} == {"x", None}


def test_lines_that_are_no_object_are_quarantined(spark, tmp_path):
    os.makedirs(f"{tmp_path}/feed")
    with open(f"{tmp_path}/feed/a.json", "w") as out:
        out.write('{"a": 1, "b": {"c": 2}}\n{broken\n[1, 2]\n\n{"a": 2.5, "d": null}\n7\n')
    assert sorted(r["value"] for r in quarantined(spark, str(tmp_path), "feed").collect()) == ["7", "[1, 2]", "{broken"]
    found = json_columns(spark, f"{tmp_path}/feed")
    assert {f.name: f.dataType.simpleString() for f in found} == {"a": "double", "b": "string", "d": "string"}


@pytest.mark.parametrize("header", [",ts_code,trade_time,close", '"","ts_code","trade_time","close"', "\ufeffx y,ts_code,trade_time,close"])
def test_bar_columns_keep_their_places_beside_unnamed_ones(spark, tmp_path, header):
    land_bars(str(tmp_path), "a", header, ['0,1.SZ,20240104093000,"5"', '"a, ""b""",2.SZ,20240104093500,', ""])
    rows = read_bars_csv(spark, f"{tmp_path}/minute_5m").select("ts_code", "trade_time", "close", "open").collect()
    assert sorted(tuple(r) for r in rows) == [("1.SZ", "20240104093000", "5", None), ("2.SZ", "20240104093500", None, None)]


def test_bar_files_have_any_number_of_columns(spark, tmp_path):
    wide = [f"c{i}" for i in range(70)]
    land_bars(str(tmp_path), "a", ",".join(["ts_code", *wide, "trade_time", "close"]), [",".join(["1.SZ", *wide, "t", "5"])])
    land_bars(str(tmp_path), "b", "close,trade_time,ts_code", ["6,u,2.SZ,more,fields"])
    rows = read_bars_csv(spark, f"{tmp_path}/minute_5m").select("ts_code", "trade_time", "close").collect()
    assert sorted(tuple(r) for r in rows) == [("1.SZ", "t", "5"), ("2.SZ", "u", "6")]


def test_a_bar_file_without_a_key_column_is_refused(spark, tmp_path):
    land_bars(str(tmp_path), "a", "ts_code,close", ["1.SZ,5"])
    with pytest.raises(Exception, match="no column trade_time in the header of .*a.csv.gz"):
        read_bars_csv(spark, f"{tmp_path}/minute_5m").collect()


def test_revised_rows_need_a_lookback(lake):
    land(lake.landing, "adj_factor", [{"ts_code": "a.SZ", "trade_date": "20241230", "adj_factor": 1}], "20241230")
    jobs.update(lake, ["adj_factor"], END, NOW)
    land(lake.landing, "adj_factor", [{"ts_code": "a.SZ", "trade_date": "20241230", "adj_factor": 2}], "20241230", "b")
    os.utime(f"{lake.landing}/adj_factor/landed_day=20241230/b.json", (4e9, 4e9))
    jobs.update(lake, ["adj_factor"], END, NOW)
    table = lake.table(SPECS["adj_factor"])
    assert content(table, "adj_factor") == [(1.0,)]
    jobs.update(lake, ["adj_factor"], END, NOW, lookback_days=5)
    assert content(table, "adj_factor") == [(2.0,)]


def test_ignore_mode_keeps_stored_rows(lake):
    land(lake.landing, "adj_factor", [{"ts_code": "a.SZ", "trade_date": "20241230", "adj_factor": 1}])
    jobs.update(lake, ["adj_factor"], END, NOW)
    land(lake.landing, "adj_factor", [{"ts_code": c, "trade_date": "20241230", "adj_factor": 2} for c in ("a.SZ", "b.SZ")])
    jobs.update(lake, ["adj_factor"], END, NOW, start=date(2024, 12, 1), write_mode="ignore")
    assert content(lake.table(SPECS["adj_factor"]), "ts_code", "adj_factor") == [("a.SZ", 1.0), ("b.SZ", 2.0)]


def test_retention_follows_each_window(lake):
    days = ["20230103", "20230131", "20230201", "20240102"]
    land(lake.landing, "adj_factor", [{"ts_code": "a.SZ", "trade_date": d, "adj_factor": 1} for d in days])
    jobs.update(lake, ["adj_factor"], END, NOW, start=date(2022, 6, 1), no_delete=True)
    table = lake.table(SPECS["adj_factor"])
    assert len(content(table, "trade_date")) == 4
    report = jobs.update(lake, ["adj_factor"], END, NOW)[-1]
    assert report.retention_cutoff == "2023-02-01" and report.rows_deleted == 2
    assert content(table, "trade_date") == [(date(2023, 2, 1),), (date(2024, 1, 2),)]


def test_short_calendar_stops_the_run(spark, tmp_path):
    land_calendar(f"{tmp_path}/in", date(2024, 6, 1))
    with pytest.raises(ValueError, match="fewer than 500"):
        jobs.update(jobs.Lake(spark, f"{tmp_path}/t", f"{tmp_path}/in"), ["adj_factor"], END, NOW)


@pytest.mark.parametrize("name", ["nothing", "minute_5m"])
def test_unknown_tables_are_refused(lake, name):
    with pytest.raises(ValueError, match="unknown"):
        jobs.update(lake, [name], END, NOW)


def test_codes_restrict_any_table(spark, lake):
    land(lake.landing, "suspend_d", [{"ts_code": c, "trade_date": "20241230", "suspend_type": "S"} for c in ("a.SZ", "b.SZ")])
    jobs.update(lake, ["suspend_d"], END, NOW, codes=spark.createDataFrame([("b.SZ",)], "ts_code string"))
    assert content(lake.table(SPECS["suspend_d"]), "ts_code") == [("b.SZ",)]


def test_dimension_and_range_tables(lake):
    land(lake.landing, "stock_basic", [{"ts_code": "a.SZ", "list_date": "19910403", "delist_date": None}])
    land(lake.landing, "namechange", [{"ts_code": "a.SZ", "name": "n", "start_date": "20240110", "end_date": ""}])
    land(lake.landing, "share_float", [{"ts_code": "a.SZ", "ann_date": "20240101", "float_date": "20240611", "holder_name": "h", "share_type": "t", "float_share": "1e3"}])
    reports = {r.table: r for r in jobs.update(lake, ["stock_basic", "st_list", "share_float", "dividend"], END, NOW)}
    assert list(reports)[:2] == ["trade_cal", "stock_basic"]
    assert content(lake.table(SPECS["stock_basic"]), "list_date") == [(date(1991, 4, 3),)]
    assert content(lake.table(SPECS["st_list"]), "start_date", "end_date") == [(date(2024, 1, 10), None)]
    assert content(lake.table(SPECS["share_float"]), "float_share") == [(1000.0,)]
    assert reports["dividend"].rows_fetched == 0 and reports["dividend"].cursor_value is None
    assert {r.table_name for r in lake.state().rows().collect()} == {"trade_cal", "st_list", "share_float"}


def test_month_backfill(lake):
    land(lake.landing, "adj_factor", [{"ts_code": "a.SZ", "trade_date": d, "adj_factor": 1} for d in ("20220801", "20241101", "20241204")])
    land(lake.landing, "stock_basic", [{"ts_code": "a.SZ"}])
    jobs.backfill_master(lake, END, NOW, 40, ["adj_factor", "stock_basic"])
    assert content(lake.table(SPECS["adj_factor"]), "trade_date") == [(date(2024, 12, 4),)]


BAR_HEADER = "ts_code,trade_time,open,high,low,close,volume,amount"
SWAPPED = "trade_time,ts_code,amount,open,high,low,close,volume"


def bar(code, stamp):
    return f"{code},{stamp},1,2,3,4,5,6"


def test_csv_is_read_by_header(spark, tmp_path):
    land_bars(tmp_path, "a", BAR_HEADER, [bar("a.SZ", "20241202093500")])
    land_bars(tmp_path, "b", SWAPPED, ["20241202094000,b.SZ,6,1,2,3,4,5"])
    land_bars(tmp_path, "c", BAR_HEADER, [])
    land_bars(tmp_path, "d", "", [])
    open(f"{tmp_path}/minute_5m/e.csv.gz", "w").close()
    got = read_bars_csv(spark, f"{tmp_path}/minute_5m").select("ts_code", "open", "amount", "volume")
    assert sorted(tuple(r) for r in got.collect()) == [("a.SZ", "1", "6", "5"), ("b.SZ", "1", "6", "5")]


def test_empty_landing_folder(spark, tmp_path):
    land_bars(tmp_path, "d", "", [])
    assert read_bars_csv(spark, f"{tmp_path}/minute_5m").count() == 0


@pytest.fixture()
def bar_lake(lake):
    land(lake.landing, "stock_basic", [{"ts_code": c} for c in ("000001.SZ", "000002.SZ")])
    jobs.update(lake, ["stock_basic"], END, NOW)
    land_bars(lake.landing, "a", BAR_HEADER, [bar("000001.SZ", "20241202093500"), bar("000002.SZ", "20241202170000"), bar("zzz.SZ", "20241202093500")], "20241202")
    land_bars(lake.landing, "b", BAR_HEADER, [bar("000002.SZ", "20241202093500.000")], "20241202")
    land_bars(lake.landing, "a", SWAPPED, ["2024-12-03 10:00:00,000001.SZ,6,1,2,3,4,5"], "20241203")
    return lake


def test_bar_update_and_cursor(bar_lake):
    report = bar_jobs.update_bars(bar_lake, NOW)
    assert report.end == END and report.rows_inserted == 4
    assert report.cursors["P2"] == date(2024, 12, 3)
    stored = bar_lake.table(BARS).read().where("ts_code = '000001.SZ'").orderBy("trade_time").collect()
    assert [(r.trade_time, r.vol_share, r.amount, r.shard) for r in stored] == [
        (datetime(2024, 12, 2, 9, 35), 500.0, 6.0, "P2"),
        (datetime(2024, 12, 3, 10, 0), 500.0, 6.0, "P2"),
    ]
    assert bar_jobs.update_bars(bar_lake, NOW).rows_fetched == 0


def test_bar_reports_tell_what_was_left_out(bar_lake):
    header = "ts_code,trade_time,open,high,low,close,volume,amount"
    rows = ["000009.SZ,20241230100000,1,1,1,1,1,1", ",20241230100500,1,1,1,1,1,1", "000009.SZ,bad,1,1,1,1,1,1", "000009.SZ,20241230200000,1,1,1,1,1,1"]
    land_bars(bar_lake.landing, "extra", header, rows, "20241230")
    report = bar_jobs.update_bars(bar_lake, NOW, end=END, count_changes=True)
    assert (report.rows_dropped, report.rows_updated, report.rows_unchanged) == (2, 0, 0)
    assert report.rows_outside >= 1 and report.rows_affected == report.rows_inserted > 0
    again = bar_jobs.update_bars(bar_lake, NOW, end=END, start=date(2024, 12, 2), count_changes=True)
    assert again.rows_affected == 0 and again.rows_unchanged == again.rows_fetched > 0


def test_drift_between_stored_shards_is_found(spark, bar_lake):
    bar_jobs.update_bars(bar_lake, NOW, end=END)
    assert bar_jobs.audit_shards(bar_lake).collect() == []
    table = bar_lake.table(BARS)
    at = table.snapshot()
    one = [p.part for p in at.parts][:1]
    drifted = table.read(one, at).withColumn("close", F.col("close").cast("string")).withColumn("volume", F.lit(1.0))
    table.replace(drifted, one, at)
    found = {r["column_name"]: (r["types"], r["text_shards"] != "", r["missing_shards"] > 0) for r in bar_jobs.audit_shards(bar_lake).collect()}
    assert found == {"close": ("double,string", True, False), "volume": ("double", False, True)}


def test_unfinished_session_waits(bar_lake):
    report = bar_jobs.update_bars(bar_lake, datetime(2024, 12, 3, 14, 0))
    assert report.end == date(2024, 12, 2) and report.cursors["P2"] == date(2024, 12, 2)


def test_backfill_resumes_with_missing_files_only(bar_lake):
    first = bar_jobs.backfill_bars(bar_lake, NOW, resume=True, end=date(2024, 12, 2))
    assert first.rows_inserted == 2  # instruments outside the universe are not loaded
    done = {r.path.rsplit("/", 2)[1] for r in bar_jobs.done_files(bar_lake).rows().collect()}
    assert done == {"landed_day=20241202"}
    second = bar_jobs.backfill_bars(bar_lake, NOW, resume=True)
    assert (second.rows_fetched, second.rows_inserted) == (1, 1)
    reset = bar_jobs.backfill_bars(bar_lake, NOW, resume=True, reset_cursor=True)
    assert (reset.rows_fetched, reset.rows_inserted) == (3, 0)


def test_half_loaded_day_is_not_skipped(bar_lake):
    """The newest stored day lacks one code: the cursor stays before it, and what lands later is loaded."""
    table, stored = bar_lake.table(BARS), ("ts_code", "trade_time", "close")
    assert bar_jobs.backfill_bars(bar_lake, NOW, resume=True).cursors["P2"] == date(2024, 12, 2)
    assert len(content(table, *stored)) == 3
    land_bars(bar_lake.landing, "b", BAR_HEADER, [bar("000002.SZ", "20241203100000")], "20241203")
    land_bars(bar_lake.landing, "z", BAR_HEADER, [bar("000002.SZ", "20241202100000")], "20241202")  # behind the cursor
    second = bar_jobs.backfill_bars(bar_lake, NOW, resume=True)
    assert second.cursors["P2"] == date(2024, 12, 3) and second.rows_inserted == 2
    assert [r[:2] for r in content(table, *stored)] == [
        ("000001.SZ", datetime(2024, 12, 2, 9, 35)), ("000001.SZ", datetime(2024, 12, 3, 10, 0)),
        ("000002.SZ", datetime(2024, 12, 2, 9, 35)), ("000002.SZ", datetime(2024, 12, 2, 10, 0)),
        ("000002.SZ", datetime(2024, 12, 3, 10, 0)),
    ]


def test_suspended_codes_are_not_waited_for(bar_lake):
    land(bar_lake.landing, "suspend_d", [{"ts_code": "000002.SZ", "trade_date": "20241203", "suspend_type": "S"}])
    jobs.update(bar_lake, ["suspend_d"], END, NOW)
    assert bar_jobs.backfill_bars(bar_lake, NOW, resume=True).cursors["P2"] == date(2024, 12, 3)


def test_rewritten_file_is_read_again(bar_lake):
    bar_jobs.update_bars(bar_lake, NOW)
    land_bars(bar_lake.landing, "a", BAR_HEADER, ["000001.SZ,20241203100000,1,2,3,9,5,6", bar("000001.SZ", "20241203100500")], "20241203")
    assert bar_jobs.update_bars(bar_lake, NOW).rows_inserted == 1
    closes = bar_lake.table(BARS).rows().where("trade_time = timestamp_ntz '2024-12-03 10:00:00'")
    assert [r.close for r in closes.collect()] == [9.0]


def test_late_rows_of_an_unfinished_day_wait_in_their_file(bar_lake):
    """A file with rows after the end day is offered again."""
    land_bars(bar_lake.landing, "m", BAR_HEADER, [bar("000001.SZ", "20241202101000"), bar("000001.SZ", "20241204101000")], "20241202")
    bar_jobs.update_bars(bar_lake, NOW, end=date(2024, 12, 3))
    bar_jobs.update_bars(bar_lake, NOW)
    assert bar_lake.table(BARS).rows().where("trade_time >= timestamp_ntz '2024-12-04 00:00:00'").count() == 1


def test_missing_bar_landing_loads_nothing(lake):
    land(lake.landing, "stock_basic", [{"ts_code": "000001.SZ"}])
    jobs.update(lake, ["stock_basic"], END, NOW)
    assert bar_jobs.update_bars(lake, NOW).rows_fetched == 0 == bar_jobs.backfill_bars(lake, NOW, resume=True).rows_fetched


def test_partial_runs_leave_the_rest_to_load(spark, bar_lake):
    one = spark.createDataFrame([("000001.SZ",)], "ts_code string")
    land(bar_lake.landing, "adj_factor", [{"ts_code": c, "trade_date": "20241230", "adj_factor": 1} for c in ("000001.SZ", "000002.SZ")])
    land(bar_lake.landing, "index_daily", [{"ts_code": "000300.SH", "trade_date": "20241230", "close": 1}])
    jobs.update(bar_lake, ["adj_factor", "index_daily"], END, NOW, codes=one)
    assert content(bar_lake.table(SPECS["index_daily"]), "ts_code") == [("000300.SH",)]  # an index is no instrument
    jobs.update(bar_lake, ["adj_factor"], END, NOW)
    assert len(content(bar_lake.table(SPECS["adj_factor"]), "ts_code")) == 2
    bar_jobs.update_bars(bar_lake, NOW, codes=one)
    assert bar_jobs.shard_cursors(bar_lake)["P2"] is None
    bar_jobs.backfill_bars(bar_lake, NOW, max_codes=1)
    assert bar_jobs.shard_cursors(bar_lake)["P2"] is None
    bar_jobs.backfill_bars(bar_lake, NOW, resume=True)
    assert len(content(bar_lake.table(BARS), "ts_code")) == 3


def test_limited_days_continue(bar_lake):
    first = bar_jobs.backfill_bars(bar_lake, NOW, keep_open_days=22, resume=True, max_days=1)
    assert (first.rows_inserted, first.cursors["P2"]) == (2, date(2024, 12, 2))
    second = bar_jobs.backfill_bars(bar_lake, NOW, keep_open_days=22, resume=True, max_days=1)
    assert second.rows_inserted == 1 and len(content(bar_lake.table(BARS), "ts_code")) == 3


def test_controlled_backfill(bar_lake):
    assert bar_jobs.backfill_bars(bar_lake, NOW, max_codes=1).rows_inserted == 2
    assert not bar_jobs.done_files(bar_lake).exists()


def test_command_line(lake, capsys):
    land(lake.landing, "adj_factor", [{"ts_code": "a.SZ", "trade_date": "20241230", "adj_factor": 1}])
    land(lake.landing, "index_weight", [{"index_code": c, "con_code": "a.SZ", "trade_date": "20241202", "weight": "1.5"} for c in ("i1", "i2")])
    place = ["--lake", lake.root, "--landing", lake.landing, "--index-codes", "i2"]
    main([*place, "update", "--tables", "adj_factor,index_weight", "--until", "2024-12-31", "--no-delete"], NOW)
    reports = json.loads(capsys.readouterr().out)
    assert [(r["table"], r["rows_inserted"]) for r in reports] == [("trade_cal", 945), ("adj_factor", 1), ("index_weight", 1)]
    with pytest.raises(SystemExit):
        main([*place, "update-bars"], NOW)


def test_repair_is_dry_by_default(spark, tmp_path):
    drifted = LakeTable(spark, f"{tmp_path}/flow", "trade_date date, hgt string")
    drifted.replace(spark.createDataFrame([(END, "1.005"), (None, "n/a")], "trade_date date, hgt string"), [""])
    report = repair_table(drifted, ["hgt", "sgt"])
    assert (report.text_columns, report.missing_columns, report.applied) == (("hgt",), ("sgt",), False)
    assert report.bad_characters == {"hgt": 1} and drifted.snapshot().rev == 1
    assert repair_table(drifted, ["hgt", "sgt"], apply=True).applied
    assert sorted(str(r.hgt) for r in drifted.rows().collect()) == ["1.01", "None"]
    assert repair_table(drifted, ["hgt"]).text_columns == ()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_other_landing_formats(spark, tmp_path, fmt):
    landing = f"{tmp_path}/in"
    cal = spark.sql(
        "select 'SSE' exchange, date_format(d, 'yyyyMMdd') cal_date, if(weekday(d) < 5, 1, 0) is_open, cast(null as string) pretrade_date "
        "from (select explode(sequence(date '2022-06-01', date '2024-12-31')) d)"
    )
    writer = cal.write.option("header", "true") if fmt == "csv" else cal.drop("pretrade_date").write
    writer.format(fmt).save(f"{landing}/trade_cal")
    rows = spark.sql("select 'a.SZ' ts_code, '20241230' trade_date, 1.5D adj_factor")
    rows.write.option("header", "true").format(fmt).save(f"{landing}/adj_factor/landed_day=20241230")
    lake = jobs.Lake(spark, f"{tmp_path}/t", landing, fmt)
    jobs.update(lake, ["adj_factor"], END, NOW)
    assert content(lake.table(SPECS["adj_factor"]), "trade_date", "adj_factor") == [(date(2024, 12, 30), 1.5)]


def test_landed_filters_reach_the_scan(spark, tmp_path):
    land_calendar(f"{tmp_path}/json")
    rows = spark.sql("select '5' ts_code, date '2024-12-30' trade_date, 1.5D close, '000300.SH' name")
    rows.write.parquet(f"{tmp_path}/in/index_daily/landed_day=20241230")
    spark.read.json(f"{tmp_path}/json/trade_cal").write.parquet(f"{tmp_path}/in/trade_cal")
    lake = jobs.Lake(spark, f"{tmp_path}/t", f"{tmp_path}/in", "parquet")
    plan = jobs.read_batch(lake, SPECS["index_daily"], date(2024, 12, 1), END)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "close#" in line)
    pushed = scan.split("PushedFilters: ")[1]
    assert "IsNotNull(trade_date)" in pushed and "In(ts_code, [" in pushed  # the text of the plan is cut off here


def test_csv_with_another_column_order_fails(spark, tmp_path):
    swapped = spark.sql("select '20241230' trade_date, 'a.SZ' ts_code, 1.5D adj_factor")
    swapped.write.option("header", "true").csv(f"{tmp_path}/adj_factor")
    with pytest.raises(Exception, match="header"):
        read_landed(spark, str(tmp_path), "adj_factor", SPECS["adj_factor"].landed()["adj_factor"], "csv").collect()


def test_stream_holds_unfinished_days_and_survives_a_restart(spark, tmp_path):
    ddl = "k string, d date, v int, seq int"
    spec = TableSpec("ticks", ("k", "d"), "k string, d date, v int", cursor="d", keep_open_days=1, partition_by=("trade_month",))
    ticks = LakeTable(spark, f"{tmp_path}/ticks", spec.schema, spec.partition_by)
    held = LakeTable(spark, f"{tmp_path}/held", "k string, d date, v int, landing_order int")

    def land_ticks(*rows):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run(done, checkpoint="c1"):
        stream = landed_stream(spark, f"{tmp_path}/in", T.StructType.fromDDL(ddl))
        ingest(stream, ticks, spec, f"{tmp_path}/{checkpoint}", "seq", done_day=lambda: done, day=F.col("d"), held=held).awaitTermination()
        return content(ticks, "k", "d", "v")

    d1, d2 = date(2024, 1, 4), date(2024, 1, 5)
    land_ticks(("a", d1, 1, 1), ("a", d2, 1, 1))
    assert run(d1) == [("a", d1, 1)]
    land_ticks(("a", d1, 2, 2), ("b", d2, 5, 2))  # a late revision and a second row of the unfinished day
    assert run(d2) == [("a", d1, 2), ("a", d2, 1), ("b", d2, 5)]
    assert run(d2, "c2") == [("a", d1, 2), ("a", d2, 1), ("b", d2, 5)]  # everything delivered again
    assert held.rows().count() == 0


# --- tables -----------------------------------------------------------------------------------------

TABLE_SCHEMA = "k string, d date, v bigint"


def sample(spark, first, last, factor=1):
    df = spark.range(first, last).selectExpr("cast(id as string) k", "date_add(date '2024-01-01', cast(id as int)) d", f"id * {factor} v")
    return df.withColumn("trade_month", F.date_format("d", "yyyy-MM"))


@pytest.fixture()
def table(spark, tmp_path):
    made = LakeTable(spark, f"{tmp_path}/t", TABLE_SCHEMA, ("trade_month",), ("k",))
    made.replace(sample(spark, 0, 100), [])
    return made


def test_replace_touches_only_its_partitions(spark, table):
    table.replace(sample(spark, 60, 70, 10), ["trade_month=2024-03"])
    revisions = {p.part: p.rev for p in table.snapshot().parts}
    assert revisions == {"trade_month=2024-01": 1, "trade_month=2024-02": 1, "trade_month=2024-03": 2, "trade_month=2024-04": 1}
    assert table.rows().count() == 31 + 29 + 10 + 9 == table.snapshot().n_rows()


def test_vanished_partition_disappears(spark, table):
    table.replace(sample(spark, 0, 0), ["trade_month=2024-01"])
    assert "trade_month=2024-01" not in {p.part for p in table.snapshot().parts}
    assert table.rows().count() == 69


def test_unlogged_revision_is_invisible(spark, table):
    sample(spark, 0, 31, 99).write.partitionBy("trade_month").parquet(f"{table.path}/data/rev=2")
    assert table.rows().agg(F.max("v")).first()[0] == 99
    assert table.rows().where("v > 99").count() == 0
    table.replace(sample(spark, 31, 60, 2), ["trade_month=2024-02"])
    assert table.rows().count() == 100


def test_columns_added_later(spark, table):
    table.replace(sample(spark, 60, 91).withColumn("note", F.lit("x")), ["trade_month=2024-03"])
    assert table.rows().columns == ["k", "d", "v", "note"]
    assert table.rows().where("note is null").count() == 69


def test_undated_rows_survive_retention(spark, tmp_path):
    undated = LakeTable(spark, f"{tmp_path}/u", TABLE_SCHEMA, ("trade_month",))
    extra = spark.createDataFrame([("n", None, 1, None)], TABLE_SCHEMA + ", trade_month string")
    undated.replace(sample(spark, 0, 100).union(extra), [])
    removed = jobs.apply_retention(undated, F.col("d"), date(2024, 2, 10))
    assert removed == 31 + 9
    assert undated.rows().count() == 61 and undated.rows().where("d is null").count() == 1
    assert jobs.apply_retention(undated, F.col("d"), date(2024, 2, 10)) == 0


def test_second_writer_from_one_snapshot_is_refused(spark, table):
    at = table.snapshot()
    table.replace(sample(spark, 60, 91, 2), ["trade_month=2024-03"], at)
    with pytest.raises(StaleSnapshot):
        table.replace(sample(spark, 0, 31, 3), ["trade_month=2024-01"], at)
    assert table.rows().where("v > 99").count() == 31 and table.rows().count() == 100
    table.replace(sample(spark, 0, 31, 3), ["trade_month=2024-01"])
    assert table.rows().count() == 100
    assert table.vacuum() == 2 + 1  # two replaced partitions and the refused write


def test_of_two_writers_that_log_at_one_moment_one_is_refused(spark, table, monkeypatch):
    at = table.snapshot()
    monkeypatch.setattr(type(table), "_newest_revision", lambda self: at.rev)  # both look before either has logged
    table.replace(sample(spark, 0, 10), [p.part for p in at.parts], at)
    with pytest.raises(StaleSnapshot, match="another writer"):
        table.replace(sample(spark, 0, 20), [p.part for p in at.parts], at)
    assert table.snapshot().rev == at.rev + 1 and table.rows().count() == 10


def test_long_log_is_cut_into_spans(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("mdlake.sources.lake.SPAN", 4)
    made = LakeTable(spark, f"{tmp_path}/t", TABLE_SCHEMA, ("trade_month",), ("k",))
    made.replace(sample(spark, 0, 100), [])
    for i in range(2, 8):
        made.replace(sample(spark, 60, 91, i), ["trade_month=2024-03"])
    at = made.snapshot()
    assert at.rev == 7 and at.n_rows() == 100 and at.schema.names == ["k", "d", "v"]
    assert made._log().count() == 4 + 3  # the live partitions, then one row per revision
    made.vacuum()
    assert made.rows().agg(F.sum("v")).first()[0] == sum(range(60)) + 7 * sum(range(60, 91)) + sum(range(91, 100))


def test_vacuum_removes_old_revisions_only(spark, table):
    table.replace(sample(spark, 60, 91, 2), ["trade_month=2024-03"])
    before = content(table, "k", "v")
    assert table.vacuum() == 1 and table.vacuum() == 0
    assert content(table, "k", "v") == before


def test_reads_prune_partitions(table):
    text = table.read().where("trade_month >= '2024-03' and v > 5")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_month" in text and "GreaterThan(v,5)" in text


# --- specifications and small operators ---------------------------------------------------------------


def test_specifications(spark):
    assert len(ALL_SPECS) == 20
    for spec in ALL_SPECS:
        names = spec.schema.names
        assert set(spec.keys) <= set(names)
        if spec.keep_open_days and spec is not BARS:
            assert spec.day in spec.keys  # rows never change partition
        assert all(set(spec.keys) <= set(s.names) for s in spec.landed().values())
    assert T.StructType.fromDDL(STATE_SCHEMA).names[0] == "cluster"


def test_orders():
    assert update_order(["daily_raw", "stock_basic", "daily_raw"]) == ["trade_cal", "stock_basic", "daily_raw"]
    assert backfill_order(["stk_limit", "adj_factor", "daily_raw", "trade_cal"]) == ["daily_raw", "adj_factor", "stk_limit"]
    assert [calendar_years(n) for n in (0, 250, 500, 2000)] == [5, 5, 5, 12]


def test_matrices_of_both_layouts(spark):
    by_time = spark.createDataFrame([("20240105093500", 1.0, None)], "t string, `a.SZ` double, `b.SH` double")
    by_code = spark.createDataFrame([("a.SZ", 5.0), ("b.SH", 6.0)], "c string, `20240105093500` double")
    long = reshape.bars_from_matrices({"open": by_time}, "t")
    assert sorted(map(tuple, long.collect())) == [("a.SZ", "20240105093500", 1.0), ("b.SH", "20240105093500", None)]
    long = reshape.bars_from_matrices({"high": by_code}, "c")
    assert sorted(map(tuple, long.collect())) == [("a.SZ", "20240105093500", 5.0), ("b.SH", "20240105093500", 6.0)]


def test_page_report(spark):
    pages = [("full", 0, 3), ("full", 1, 1), ("cut", 0, 3), ("cut", 1, 3), ("gap", 0, 3), ("gap", 2, 1), ("one", 0, 2)]
    rows = [(u, p) for u, p, n in pages for _ in range(n)]
    report = quality.page_completeness(spark.createDataFrame(rows, "u string, p int"), ["u"], "p", 3)
    got = {r.u: (r.complete, r.possibly_truncated, r.missing_pages) for r in report.collect()}
    assert got == {"full": (True, False, 0), "cut": (False, True, 0), "gap": (False, False, 1), "one": (True, False, 0)}


def test_repair_rejects_what_either_test_rejects(spark):
    df = spark.createDataFrame([("1.005",), ("1-2",), ("1e3",), ("",), (" 7",), (None,)], "v string")
    got = [r.v for r in quality.repair_types(df, ["v"]).collect()]
    assert [None if v is None else str(v) for v in got] == ["1.01", None, None, None, None, None]


def test_jobs_evaluate_wide_steps_in_short_methods(spark, tmp_path, monkeypatch):
    """While a job runs, Spark makes no method that the JVM would interpret; afterwards the session is as it was."""
    before = spark.conf.get(session.METHOD_LIMIT)
    seen = []
    real = jobs.read_batch

    def reading(lake, *args, **kwargs):
        seen.append(int(lake.spark.conf.get(session.METHOD_LIMIT)))
        return real(lake, *args, **kwargs)

    monkeypatch.setattr(jobs, "read_batch", reading)
    lake = jobs.Lake(spark, str(tmp_path / "tables"), str(tmp_path / "landing"))
    (tmp_path / "landing" / "trade_cal").mkdir(parents=True)
    (tmp_path / "landing" / "trade_cal" / "a.json").write_text('{"exchange":"SSE","cal_date":"20240102","is_open":"1"}\n')
    jobs.update(lake, ["trade_cal"], date(2024, 1, 31), datetime(2024, 1, 31, 16))
    assert seen and max(seen) <= 8000 and spark.conf.get(session.METHOD_LIMIT) == before
    assert lake.calendar().count() == 1
    with pytest.raises(ValueError):
        jobs.update(lake, ["no_such_table"], date(2024, 1, 31), datetime(2024, 1, 31, 16))
    assert spark.conf.get(session.METHOD_LIMIT) == before
