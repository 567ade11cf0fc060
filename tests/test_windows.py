"""Work windows, start dates, cursors, positions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
import pytest
from pyspark.sql import functions as F

from mdlake.operators import calendar as cal_ops, ranking, state, windows

D = date
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def span(spark, start, end):
    return spark.createDataFrame([(start, end)], "s date, e date")


def pairs(df):
    return [(r.window_start, r.window_end) for r in df.orderBy("window_start").collect()]


def test_fixed_windows(spark):
    got = pairs(windows.fixed_windows(span(spark, D(2024, 1, 1), D(2024, 7, 15)), F.col("s"), F.col("e")))
    assert got == [(D(2024, 1, 1), D(2024, 3, 31)), (D(2024, 4, 1), D(2024, 6, 30)), (D(2024, 7, 1), D(2024, 7, 15))]


def test_month_windows(spark):
    df = span(spark, D(2024, 1, 15), D(2024, 3, 10))
    floor = pairs(windows.month_windows(df, F.col("s"), F.col("e"), clamp=False))
    assert floor == [(D(2024, 1, 1), D(2024, 1, 31)), (D(2024, 2, 1), D(2024, 2, 29)), (D(2024, 3, 1), D(2024, 3, 10))]
    assert pairs(windows.month_windows(df, F.col("s"), F.col("e"), clamp=True))[0] == (D(2024, 1, 15), D(2024, 1, 31))


def test_reversed_range_has_no_windows(spark):
    df = span(spark, D(2024, 3, 1), D(2024, 1, 1))
    assert pairs(windows.fixed_windows(df, F.col("s"), F.col("e"))) == []
    assert pairs(windows.month_windows(df, F.col("s"), F.col("e"), clamp=True)) == []


@few
@given(st.dates(D(2000, 1, 1), D(2030, 1, 1)), st.integers(0, 400), st.integers(0, 120))
def test_windows_tile_the_range(spark, start, length, step):
    end = start + timedelta(days=length)
    df = span(spark, start, end)
    for got in (
        pairs(windows.fixed_windows(df, F.col("s"), F.col("e"), step)),
        pairs(windows.month_windows(df, F.col("s"), F.col("e"), clamp=True)),
    ):
        assert got[0][0] == start and got[-1][1] == end
        assert all(a[1] + timedelta(days=1) == b[0] for a, b in zip(got, got[1:]))


def halved(counts, lo, hi, cap):
    total = sum(counts.get(lo + timedelta(days=i), 0) for i in range((hi - lo).days + 1))
    if total < cap or lo == hi:
        return [(lo, hi, total, total >= cap)]
    middle = lo + timedelta(days=(hi - lo).days // 2)
    return halved(counts, lo, middle, cap) + halved(counts, middle + timedelta(days=1), hi, cap)


@few
@given(st.dictionaries(st.integers(1, 31), st.integers(0, 40), min_size=1, max_size=20), st.integers(1, 31), st.integers(5, 80))
def test_bisection_matches_recursion(spark, per_day, last, cap):
    counts = {D(2024, 1, d): n for d, n in per_day.items() if d <= last}
    if not counts:
        return
    df = spark.createDataFrame([("a", d, n) for d, n in counts.items()], "g string, day date, n bigint")
    got = windows.bisect_windows(df, ["g"], cap, end=D(2024, 1, last)).orderBy("window_start").collect()
    assert [tuple(r)[1:] for r in got] == halved(counts, D(2024, 1, 1), D(2024, 1, last), cap)


def test_row_cap():
    assert windows.row_cap() == 102000


@pytest.mark.parametrize(
    "requested, cursor, cutoff, lookback, expected",
    [
        (D(2024, 5, 1), D(2024, 6, 1), None, 0, D(2024, 5, 1)),
        (None, D(2024, 6, 1), None, 0, D(2024, 6, 2)),
        (None, None, D(2024, 2, 1), 0, D(2024, 2, 1)),
        (None, None, None, 0, D(2024, 12, 31) - timedelta(days=7300)),
        (D(2020, 1, 1), None, D(2024, 2, 1), 0, D(2024, 2, 1)),
        (None, D(2024, 12, 30), D(2024, 2, 1), 30, D(2024, 11, 1)),
        (None, D(2024, 12, 30), D(2024, 12, 1), 30, D(2024, 12, 1)),
        (D(2024, 3, 1), None, None, 10, D(2024, 3, 1)),
    ],
)
def test_plan_start(spark, requested, cursor, cutoff, lookback, expected):
    df = spark.createDataFrame([(requested, cursor, cutoff)], "r date, c date, k date")
    start = state.plan_start(F.col("r"), F.col("c"), F.col("k"), F.lit(D(2024, 12, 31)), lookback)
    assert df.select(start.alias("s")).first().s == expected


@pytest.mark.parametrize(
    "current, newest, n, expected",
    [
        (D(2024, 1, 10), D(2024, 1, 5), 3, D(2024, 1, 10)),
        (None, None, 0, None),
        (None, None, 3, D(2024, 2, 1)),
        (D(2024, 1, 10), None, 0, D(2024, 1, 10)),
        (D(2024, 1, 10), D(2024, 1, 12), 1, D(2024, 1, 12)),
    ],
)
def test_advance_cursor(spark, current, newest, n, expected):
    df = spark.createDataFrame([(current, newest, n)], "c date, m date, n int")
    value = state.advance_cursor(F.col("c"), F.col("m"), F.col("n"), F.lit(D(2024, 2, 1)))
    assert df.select(value.alias("v")).first().v == expected


def calendar(spark, start, end):
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    return spark.createDataFrame([("SSE", d, int(d.weekday() < 5)) for d in days], "exchange string, cal_date date, is_open bigint")


def test_cutoff_needs_enough_days(spark):
    cal = calendar(spark, D(2024, 1, 1), D(2024, 1, 31))
    cutoff = lambda n, end=D(2024, 1, 31): cal_ops.cutoff_last_open_days(cal, n, end).first().cutoff
    assert cutoff(1) == D(2024, 1, 31)
    assert cutoff(23) == D(2024, 1, 1)
    assert cutoff(24) is None and cutoff(0) is None and cutoff(-1) is None
    assert cutoff(2, D(2024, 1, 7)) == D(2024, 1, 4)


@pytest.mark.parametrize(
    "end, now, explicit, expected",
    [
        (D(2024, 1, 10), datetime(2024, 1, 10, 10), True, D(2024, 1, 10)),
        (D(2024, 1, 9), datetime(2024, 1, 10, 10), False, D(2024, 1, 9)),
        (D(2024, 1, 10), datetime(2024, 1, 10, 15, 5), False, D(2024, 1, 10)),
        (D(2024, 1, 10), datetime(2024, 1, 10, 15, 4, 59), False, D(2024, 1, 9)),
        (D(2024, 1, 8), datetime(2024, 1, 8, 9), False, D(2024, 1, 5)),
        (D(2024, 2, 10), datetime(2024, 2, 10, 9), False, D(2024, 1, 31)),
        (D(2024, 3, 10), datetime(2024, 3, 10, 9), False, D(2024, 3, 9)),
    ],
)
def test_last_completed_day(spark, end, now, explicit, expected):
    df = spark.createDataFrame([(end, now, explicit)], "e date, n timestamp_ntz, x boolean")
    cal = calendar(spark, D(2024, 1, 1), D(2024, 1, 31))
    got = cal_ops.last_completed_day(df, cal, F.col("e"), F.col("n"), F.col("x"))
    assert got.first().done_day == expected


def test_previous_open_day(spark):
    got = cal_ops.previous_open_days(calendar(spark, D(2024, 1, 4), D(2024, 1, 9))).orderBy("cal_date").collect()
    assert [r.prev_open for r in got] == [None, D(2024, 1, 4), D(2024, 1, 5), D(2024, 1, 8)]


def test_positions_of_one_large_group(spark):
    df = spark.range(0, 20000, 1, 7).selectExpr("'g' as g", "lpad(cast((id * 7919) % 20000 as string), 6, '0') as c")
    got = ranking.positions(df, "g", "c")
    assert got.where("pos <> cast(c as bigint)").count() == 0
    assert got.count() == 20000


def test_chunks(spark):
    df = spark.createDataFrame([("P1", f"{i:03d}") for i in range(5)] + [("P2", "000")], "shard string, ts_code string")
    got = ranking.chunk_codes(df, 2).orderBy("shard", "ts_code").collect()
    assert [(r.chunk, r.n_chunks) for r in got] == [(1, 3), (1, 3), (2, 3), (2, 3), (3, 3), (1, 1)]


def test_seeded_sample_has_the_asked_size(spark):
    df = spark.range(50).selectExpr("cast(id as string) as ts_code")
    assert ranking.sample_codes(df, 7, seed=3).count() == 7


def test_fast_forward(spark):
    rows = [(None, D(2024, 1, 5)), (D(2024, 1, 8), D(2024, 1, 5)), (D(2024, 1, 3), D(2024, 1, 5)), (D(2024, 1, 3), D(2024, 3, 5)), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c date, n date")
    moved = state.fast_forward(F.col("c"), F.col("n"), F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 31)))
    got = [r.m for r in df.select("i", moved.alias("m")).orderBy("i").collect()]
    assert got == [D(2024, 1, 5), D(2024, 1, 8), D(2024, 1, 5), D(2024, 1, 3), None]
