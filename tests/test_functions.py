"""Golden rows of the column functions, and agreement with pandas on generated text."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
import hashlib
import warnings

from hypothesis import HealthCheck, given, settings, strategies as st
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mdlake.functions import codes, dates, numbers
from mdlake.operators import cleaning


def evaluate(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


GOOD_DATES = {
    "20240131": date(2024, 1, 31),
    "20240131.0": date(2024, 1, 31),
    "19000101": date(1900, 1, 1),
    "16770922": date(1677, 9, 22),
    "22620411": date(2262, 4, 11),
    "202401 5": date(2024, 1, 5),
}
BAD_DATES = [
    "16770921", "22620412", "99991231", "20240230", "2024-01-31", "202401311", None, "131", "", " 20240131", "20240131 ",
    "nan", "00000000", "20240131\n", "2024013", "20240131.00", "+2024131", "2024-1-5", "2024", "二〇二四",
]


def test_compact_dates(spark):
    expected = list(GOOD_DATES.values()) + [None] * len(BAD_DATES)
    assert evaluate(spark, list(GOOD_DATES) + BAD_DATES, dates.parse_compact_date) == expected


def test_wide_dates(spark):
    parse = lambda c: dates.parse_compact_date(c, wide_dates=True)
    assert evaluate(spark, ["99991231", "16000229", "20230229"], parse) == [date(9999, 12, 31), date(1600, 2, 29), None]


def pandas_dates(values):
    text = pd.Series(values, dtype=object).astype(str).str.replace(r"\.0$", "", regex=True).str.zfill(8)
    parsed = pd.to_datetime(text, format="%Y%m%d", errors="coerce")
    return [None if pd.isna(v) else v.date() for v in parsed]


def pandas_numbers(values):
    parsed = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce")
    return [None if pd.isna(v) or abs(v) == float("inf") else float(v) for v in parsed]


relaxed = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
digits = st.text("0123456789", min_size=6, max_size=9)
near_dates = st.builds(lambda y, m, d, t: f"{y:04d}{m:02d}{d:02d}{t}", st.integers(1500, 2400), st.integers(0, 13), st.integers(0, 32), st.sampled_from(["", ".0", " ", ".00"]))


@relaxed
@given(st.lists(st.one_of(digits, near_dates, st.text("0123456789. -", max_size=10)), min_size=40, max_size=120))
def test_dates_agree_with_pandas(spark, values):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert evaluate(spark, values, dates.parse_compact_date) == pandas_dates(values)


@relaxed
@given(st.lists(st.text("0123456789.eE+- dfnaxi,_", max_size=8), min_size=40, max_size=120))
def test_numbers_agree_with_pandas(spark, values):
    assert evaluate(spark, values, numbers.to_number) == pandas_numbers(values)


def test_numbers(spark):
    good = {"1e3": 1000.0, " 12 ": 12.0, "+5": 5.0, ".5": 0.5, "5.": 5.0}
    bad = ["nan", "NaN", "1d", "1f", "2.5D", "1e3d", "0x10", "1,000", "", "1_000", "True", "-", "1e", "inf", "-inf", "Infinity", "1e999", None]
    assert evaluate(spark, list(good) + bad, numbers.to_number) == list(good.values()) + [None] * len(bad)


def test_decimals_round_half_up(spark):
    assert evaluate(spark, ["1.005", "-2.345", "", "1-2"], numbers.to_decimal) == [Decimal("1.01"), Decimal("-2.35"), None, None]


def test_open_flag(spark):
    assert evaluate(spark, ["1", "0", "1.5", "x", None, "1e300"], numbers.open_flag) == [1, 0, 1, 0, 0, 0]


def test_timestamps_with_a_good_row(spark):
    rows = [
        ("a", "20260205093000.000"), ("a", "20260205093000.0"), ("a", "20260205 093000"), ("a", "20260205096100"),
        ("a", "202602050930"), ("a", "2026-02-05 09:30:00"), ("a", None),
    ]
    df = spark.createDataFrame(rows, "batch string, t string").withColumn("i", F.monotonically_increasing_id())
    got = [r.t for r in cleaning.normalize_timestamps(df, "t", "batch").orderBy("i").collect()]
    assert got == [datetime(2026, 2, 5, 9, 30)] * 3 + [None] * 4


@pytest.mark.parametrize(
    "texts, expected",
    [
        (["2026-02-05 09:30:00"], [datetime(2026, 2, 5, 9, 30)]),
        (["2026-02-05 09:30:00", "bad"], [datetime(2026, 2, 5, 9, 30), None]),
        (["20260205096100", "202602050930"], [None, datetime(2026, 2, 5, 9, 30)]),
        (["2026/02/05 09:30:00", "20260205"], [datetime(2026, 2, 5, 9, 30), datetime(2026, 2, 5)]),
    ],
)
def test_timestamps_of_a_failed_batch(spark, texts, expected):
    df = spark.createDataFrame([(i, "b", t) for i, t in enumerate(texts)], "i int, batch string, t string")
    assert [r.t for r in cleaning.normalize_timestamps(df, "t", "batch").orderBy("i").collect()] == expected


def test_timestamps_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist in that zone on this day
        assert evaluate(spark, ["20240310023000"], dates.parse_compact_timestamp) == [datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_any_date(spark):
    values = ["2024-01-31", "20240131", " 20240131 ", "2024-02-30", "2024013", "", None, "x-y"]
    assert evaluate(spark, values, dates.parse_date_any) == [date(2024, 1, 31)] * 3 + [None] * 5


def test_session_bounds(spark):
    stamps = [datetime(2024, 1, 5, 9, 29, 59), datetime(2024, 1, 5, 9, 30), datetime(2024, 1, 5, 15, 0), datetime(2024, 1, 5, 15, 0, 1)]
    assert evaluate(spark, stamps, dates.in_session, "timestamp_ntz") == [False, True, True, False]


def test_codes(spark):
    assert evaluate(spark, ["000001.SZ", " 600000.sh ", "x.BJ", "000001", "a.SZ.x", None], codes.is_code) == [True, True, True, False, False, False]


def test_shards_match_the_hash(spark):
    values = ["000001.SZ", "600000.SH", "430047.BJ", "", "ü"]
    expected = [int(hashlib.md5(v.encode()).hexdigest()[:8], 16) % 3 for v in values]
    assert evaluate(spark, values, codes.shard_number) == expected
    assert evaluate(spark, ["000001.SZ"], codes.shard_label) == ["P2"]


def test_progress_markers(spark):
    values = ["2024-01-05@40", "20240105@3", "2024-01-05@-2", "2024-01-05@x", "bad@4", "2024-01-05", None, "2024-01-05@1@2"]
    day = date(2024, 1, 5)
    assert evaluate(spark, values, codes.progress_day) == [day, day, day, None, None, None, None, None]
    assert evaluate(spark, values, codes.progress_position) == [40, 3, 0, 0, 0, 0, 0, 0]


def test_progress_marker_round_trip(spark):
    df = spark.createDataFrame([(date(2024, 1, 5), 40)], "d date, n int")
    marker = codes.progress_marker(F.col("d"), F.col("n"))
    assert tuple(df.select(marker, codes.progress_day(marker), codes.progress_position(marker)).first()) == (
        "2024-01-05@40", date(2024, 1, 5), 40,
    )


def test_float_columns_become_text_without_fraction(spark):
    df = spark.createDataFrame([(20240131.0,), (20240131.5,), (float("nan"),)], "d double")
    assert [r.d for r in cleaning.normalize_dates(df, ["d"]).collect()] == [date(2024, 1, 31), None, None]


def test_nan_and_keys(spark):
    df = spark.createDataFrame([("a", float("nan")), (None, 1.0)], "k string, v double")
    cleaned = cleaning.drop_null_keys(cleaning.nan_to_null(df), ["k"])
    assert [tuple(r) for r in cleaned.collect()] == [("a", None)]
