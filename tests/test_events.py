"""Event-time streams against batch results, late rows, and errors of stored sketches."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
import random

from pyspark.sql import functions as F
import pytest

from mdlake.operators import sketches
from mdlake.streaming import events, sessions
from mdlake.streaming.ingest import landed_stream
from mdlake.views import event_checks

BAR = "ts_code string, trade_time timestamp, open double, high double, low double, close double, volume long, amount long"
T0 = datetime(2024, 1, 2, 9, 30)


def bars_at(minutes, code="a.SZ", value=1.0):
    return [(code, T0 + timedelta(minutes=m), value + m, value + m + 1, value + m - 1, value + m + 0.5, m, 10 * m) for m in minutes]


def land_files(spark, path, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def run(spark, root, out):
    query = events.to_files(out, f"{root}/out", f"{root}/checkpoint")
    query.awaitTermination()
    return query, spark.read.schema(out.schema).parquet(f"{root}/out")


def test_late_bars_are_dropped_and_counted(spark, tmp_path):
    batches = [bars_at([0, 5, 25, 30]), bars_at([300]), bars_at([301]), bars_at([10, 305]), bars_at([700])]  # a batch is judged by the mark two batches before
    land_files(spark, f"{tmp_path}/in", batches, BAR)
    stream = landed_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], BAR).schema, files_per_batch=1)
    query, found = run(spark, tmp_path, events.with_start(events.resampled(stream, ["ts_code"], "trade_time", "30 minutes", "60 minutes"), "trade_time"))
    rows = {r["trade_time"]: r for r in found.collect()}
    first = rows[T0]
    assert (first["open"], first["close"], first["high"], first["low"], first["volume"]) == (1.0, 26.5, 27.0, 0.0, 30)  # not the late bar of minute 10
    assert events.late_rows(query) == 1
    batch = events.with_start(events.resampled(spark.createDataFrame(bars_at([0, 5, 25, 30, 300, 301, 305]), BAR), ["ts_code"], "trade_time", "30 minutes"), "trade_time")
    assert {tuple(r) for r in batch.collect()} == {tuple(r) for r in found.select(batch.columns).collect()}


@pytest.mark.parametrize("late", ["main", "extra"])
def test_feeds_meet_in_either_order(spark, tmp_path, late):
    day = [datetime(2024, 1, d) for d in range(1, 12)]
    main = [[(c, d, 1) for c in ("a", "b")] for d in day]
    extra = [[(c, d, 2) for c in ("b", "c")] for d in day]
    batches = {"main": main, "extra": extra}
    batches[late] = [[], *batches[late]]  # one file behind
    for name in batches:
        land_files(spark, f"{tmp_path}/{name}", [b for b in batches[name]], f"code string, day timestamp, {name} long")
    frames = {n: landed_stream(spark, f"{tmp_path}/{n}", spark.read.parquet(f"{tmp_path}/{n}").schema, files_per_batch=1) for n in batches}
    _, found = run(spark, tmp_path, events.met_feeds(frames["main"], frames["extra"], ["code"], "day", "2 days"))
    got = {(r["code"], r["day"].day): (r["main"], r["extra"]) for r in found.collect()}
    assert len(got) == found.count()
    assert {k: v for k, v in got.items() if k[0] == "b"} == {("b", d): (1, 2) for d in range(1, 12)}
    alone = {k for k in got if k[0] != "b"}
    assert all(got[k] == ((1, None) if k[0] == "a" else (None, 2)) for k in alone)
    assert {d for _, d in alone} == set(range(1, 10))  # the watermark stands at day 9


def test_tasks_share_a_span_and_a_batch_reads_one_whole_span(spark, tmp_path):
    """Spans of many rows, of none, of one row and of two; files without rows fill up the sets."""
    many = [("a.SZ", datetime(2024, 1, 2 + i % 7) + timedelta(seconds=i), i) for i in range(2000)]
    few = [("a.SZ", datetime(2024, 1, 20), -1), ("a.SZ", datetime(2024, 1, 26), -2), ("b.SZ", datetime(2024, 1, 27), -3), ("c.SZ", None, -4)]
    rows = spark.createDataFrame([*many, *few], "ts_code string, trade_time timestamp, n long")
    stream = event_checks._stream_of(spark, rows, F.col("trade_time").cast("date"), f"{tmp_path}/in")
    batches = {}
    seen = lambda df, k: batches.update({k: [(r["file"], r["n"]) for r in df.collect()]})
    stream.withColumn("file", F.input_file_name()).writeStream.foreachBatch(seen).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    assert [sorted(n for _, n in batches[k]) for k in sorted(batches)] == [list(range(2000)), [], [-1], [-3, -2]]
    assert len({file for file, _ in batches[0]}) == spark.sparkContext.defaultParallelism > 1


def test_feeds_with_a_common_column_are_refused(spark):
    a = spark.createDataFrame([], "code string, day timestamp, close double")
    with pytest.raises(ValueError, match="both feeds"):
        events.met_feeds(a, a, ["code"], "day", "1 day")


def test_sessions_close_by_timer_across_a_restart(spark, tmp_path):
    sessions.use_rocksdb(spark)
    schema = "ts_code string, trade_time timestamp, close double"
    day = lambda d, m: T0 + timedelta(days=d, minutes=m)
    first = [("a.SZ", day(0, 0), 1.0), ("a.SZ", day(0, 7), 2.0), ("b.SZ", day(0, 330), 3.0), ("a.SZ", day(0, 600), 9.0)]
    later = [("b.SZ", day(0, 325), 2.5), ("b.SZ", day(1, 0), 4.0), ("a.SZ", day(3, 0), 5.0), ("a.SZ", day(0, 10), 8.0)]  # the last is late
    stream = lambda: landed_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, files_per_batch=1)
    land_files(spark, f"{tmp_path}/in", [first], schema)
    _, found = run(spark, tmp_path, sessions.closed_sessions(stream(), "1 hour"))
    assert found.count() == 0  # held in state, nothing written
    land_files(spark, f"{tmp_path}/in", [later], schema)
    _, found = run(spark, tmp_path, sessions.closed_sessions(stream(), "1 hour"))
    rows = {(r["ts_code"], r["trade_time"]): (r["close"], r["kind"]) for r in found.collect()}
    slots = [s.astimezone(timezone.utc).replace(tzinfo=None) for s in sessions.session_slots(T0.date())]
    assert len(slots) == 67 and found.count() == 3 * 67
    have = {("a.SZ", day(0, 0)): 1.0, ("a.SZ", day(0, 5)): 2.0, ("b.SZ", day(0, 330)): 3.0, ("b.SZ", day(0, 325)): 2.5, ("b.SZ", day(1, 0)): 4.0}
    for (code, at), (close, kind) in rows.items():
        assert (close, kind) == ((have[code, at], "bar") if (code, at) in have else (None, "missing"))
    assert {(c, t.date()) for c, t in rows} == {("a.SZ", day(0, 0).date()), ("b.SZ", day(0, 0).date()), ("b.SZ", day(1, 0).date())}


def test_merged_states_equal_the_state_of_all_rows_within_the_error(spark):
    random.seed(1)
    rows = [(random.choice("xy"), random.randrange(10), random.randrange(30_000), random.gauss(0, 1)) for _ in range(60_000)]
    df = spark.createDataFrame([*rows, ("z", 1, None, None)], "part string, day int, user long, value double")
    distinct, quantile = {"users": "user"}, {"values": "value"}
    by_day = sketches.states(df, ["part", "day"], distinct, quantile)
    merged = sketches.merged(sketches.merged(by_day, ["part", "day"], ["users"], ["values"]), ["part"], ["users"], ["values"])
    got = {r["part"]: r for r in sketches.estimates(merged, ["users"], ["values"], [0.1, 0.5, 0.99]).collect()}
    for part in "xy":
        users = {u for p, _, u, _ in rows if p == part}
        values = sorted(v for p, _, _, v in rows if p == part)
        assert got[part]["n_rows"] == len(values)
        assert abs(got[part]["users"] - len(users)) <= 0.05 * len(users)
        for rank, value in zip([0.1, 0.5, 0.99], got[part]["values"]):
            assert abs(sum(v <= value for v in values) / len(values) - rank) < 0.03
    assert (got["z"]["n_rows"], got["z"]["users"], got["z"]["values"]) == (1, 0, None)


def test_a_closed_session_leaves_python_as_one_row():
    """However many slots it has; Spark makes the rows of its slots."""

    class Held:
        def iterator(self):
            return iter([((1,), (2.0,)), ((3,), (None,))])

        def clear(self):
            self.cleared = True

    processor = sessions.SessionProcessor()
    processor.held = Held()
    (row,) = processor.handleExpiredTimer(("a", T0.date()), None, None)
    assert row.asDict() == {"ts_code": "a", "day": T0.date(), "held": {1: 2.0, 3: None}} and processor.held.cleared
