"""Golden rows and properties of the keyed operators."""

from __future__ import annotations

from datetime import date

from hypothesis import HealthCheck, example, given, settings, strategies as st
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from mdlake.operators import merge, retention

KEYS = ["k"]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([("k1", 1, 1)], "k string, a int, b int")


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame([("k1", 2, 1), ("k1", 3, 2), ("k2", 4, 3)], "k string, a int, seq int")


def test_upsert_replaces_whole_rows(target, batch):
    assert rows(merge.upsert(target, batch, KEYS, ["seq"])) == [("k1", 3, None), ("k2", 4, None)]


def test_upsert_keep_absent(target, batch):
    assert rows(merge.upsert(target, batch, KEYS, ["seq"], keep_absent=True)) == [("k1", 3, 1), ("k2", 4, None)]


def test_insert_ignore(target, batch):
    assert rows(merge.insert_ignore(target, batch, KEYS, ["seq"])) == [("k1", 1, 1), ("k2", 4, None)]


def test_ignore_keeps_the_first_duplicate(spark, target):
    fresh = spark.createDataFrame([("k9", 7, 2), ("k9", 6, 1)], "k string, a int, seq int")
    assert rows(merge.insert_ignore(target, fresh, KEYS, ["seq"]))[1] == ("k9", 6, None)


def test_new_columns_are_added(spark, target):
    wider = spark.createDataFrame([("k2", 1, "x", 1)], "k string, a int, note string, seq int")
    merged = merge.upsert(target, wider, KEYS, ["seq"])
    assert merged.columns == ["k", "a", "b", "note"]
    assert rows(merged) == [("k1", 1, 1, None), ("k2", 1, None, "x")]


def test_missing_key_column_is_an_error(spark, target):
    with pytest.raises(ValueError):
        merge.evolve_schema(target, spark.createDataFrame([(1,)], "a int"), KEYS)


def test_text_is_cast_to_the_target_type(spark, target):
    text = spark.createDataFrame([("k1", "x", 1), ("k2", "5", 2)], "k string, a string, seq int")
    assert rows(merge.upsert(target, text, KEYS, ["seq"])) == [("k1", None, None), ("k2", 5, None)]


pairs = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 9)), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs, pairs)
def test_upsert_and_ignore_match_a_dictionary(spark, old, new):
    stored = dict(old)
    target = spark.createDataFrame(list(stored.items()), "k string, v int")
    batch = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(new)], "k string, v int, seq int")
    once = merge.upsert(target, batch, KEYS, ["seq"])
    assert dict(rows(once)) == stored | dict(new)
    assert rows(merge.upsert(once, batch, KEYS, ["seq"])) == rows(once)
    ignored = merge.insert_ignore(target, batch, KEYS, ["seq"])
    assert dict(rows(ignored)) == dict(reversed(new)) | stored
    assert rows(merge.insert_ignore(ignored, batch, KEYS, ["seq"])) == rows(ignored)


FEED = "ts_code string, trade_date date, close double"
DAY, EMPTY_DAY = date(2024, 1, 5), date(2024, 1, 8)


def test_feed_merge(spark):
    main = spark.createDataFrame([("A", DAY, 1.0), ("B", DAY, 2.0), (None, DAY, 3.0)], FEED)
    extra = spark.createDataFrame(
        [("A", DAY, 9.0, 0.1), ("C", DAY, 8.0, 0.2), (None, DAY, 7.0, 0.3), ("C", EMPTY_DAY, 8.0, 0.4)], f"{FEED}, pe double"
    )
    merged = merge.merge_feeds(main, extra, ["ts_code", "trade_date"], "trade_date")
    assert rows(merged, "trade_date", "ts_code") == [
        (None, DAY, 3.0, 0.3),
        ("A", DAY, 1.0, 0.1),
        ("B", DAY, 2.0, None),
        ("C", DAY, None, 0.2),
        ("C", EMPTY_DAY, 8.0, 0.4),
    ]


def test_feed_merge_resolves_duplicates_first(spark):
    main = spark.createDataFrame([("A", DAY, 1.0, 1), ("A", DAY, 2.0, 2)], f"{FEED}, seq int")
    extra = spark.createDataFrame([("A", DAY, 0.1, 1), ("A", DAY, 0.2, 2)], "ts_code string, trade_date date, pe double, seq int")
    merged = merge.merge_feeds(main, extra, ["ts_code", "trade_date"], "trade_date", order=["seq"], null_safe=False)
    assert rows(merged) == [("A", DAY, 2.0, 0.2)]


feed_rows = st.lists(st.tuples(st.sampled_from("ABC"), st.integers(4, 6), st.integers(0, 9)), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@example([], [])
@example([("A", 4, 1)], [])
@example([], [("A", 4, 1)])
@given(feed_rows, feed_rows)
def test_feed_merge_matches_day_by_day_pandas(spark, main_rows, extra_rows):
    """One outer merge per day, an empty side passing the other unchanged."""
    main = pd.DataFrame({(c, d): v for c, d, v in main_rows}.items(), columns=["k", "close"])
    extra = pd.DataFrame({(c, d): v for c, d, v in extra_rows}.items(), columns=["k", "close"])
    expected = set()
    for day in {k[1] for k in [*main["k"], *extra["k"]]}:
        a, b = (f[f["k"].map(lambda k: k[1] == day).astype(bool)] for f in (main, extra))
        b = b.assign(pe=b["close"] * 2)
        if a.empty or b.empty:
            merged = (b if a.empty else a).reindex(columns=["k", "close", "pe"])
        else:
            merged = a.merge(b.drop(columns=["close"]), on="k", how="outer")
        expected |= {(*r.k, None if pd.isna(r.close) else r.close, None if pd.isna(r.pe) else r.pe) for r in merged.itertuples()}

    def frame(rows, columns, extra_columns=()):
        days = [(c, date(2024, 1, d), float(v), *[float(v) * 2 for _ in extra_columns], i) for i, (c, d, v) in enumerate(rows)]
        return spark.createDataFrame(days, ", ".join([columns, *extra_columns, "seq int"]))

    merged = merge.merge_feeds(
        frame(main_rows, FEED), frame(extra_rows, FEED, ["pe double"]), ["ts_code", "trade_date"], "trade_date", order=["seq"]
    )
    assert {(r.ts_code, r.trade_date.day, r.close, r.pe) for r in merged.collect()} == expected


def test_union_by_name_casts_first(spark):
    text = spark.createDataFrame([("x", "n/a"), ("y", "2")], "k string, v string")
    number = spark.createDataFrame([(3, "z")], "v bigint, k string")
    schema = T.StructType.fromDDL("k string, v double, w string")
    assert rows(merge.union_by_name([text, number], schema), "k") == [("x", None), ("y", 2.0), ("z", 3.0)]


def test_change_summary(spark, target):
    batch = spark.createDataFrame([("k1", 1, 1, 1), ("k2", 1, 1, 2)], "k string, a int, b int, seq int")
    assert rows(merge.change_summary(target, batch, KEYS, ["seq"])) == [("k1", "unchanged"), ("k2", "inserted")]


def test_retention_keeps_missing_dates(spark):
    days = spark.createDataFrame([(None,), (date(2024, 1, 4),), (DAY,), (EMPTY_DAY,)], "d date")
    kept = retention.keep_recent(days, F.col("d"), DAY)
    assert {r.d for r in kept.collect()} == {None, DAY, EMPTY_DAY}
    split = retention.retention_split(days, F.col("d"), DAY, [F.lit("t").alias("t")])
    assert rows(split) == [("t", 3, 1)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicates_are_cut_before_the_shuffle(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = plan(merge.last_per_key(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey"]))
    assert "row_number(), 1, Partial" in text


def test_one_hot_key_ships_one_row_per_task(spark):
    # a third of all rows share one key
    hot = spark.range(0, 90000, 1, 6).selectExpr("case when id % 3 = 0 then -1 else id end as k", "id as v", "id as seq")
    target = spark.range(0, 10).selectExpr("id as k", "id as v")
    merged = merge.upsert(target, hot, KEYS, ["seq"])
    assert merged.where("k = -1").collect()[0].v == 89997
    assert merged.count() == 60001 + 4  # 0, 3, 6, 9 only exist in the target


def test_small_batch_never_shuffles_the_target(spark, sf_dir, tmp_path):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_tax")
    made = spark.createDataFrame([(1, 1, 0.5, 1)], "l_orderkey bigint, l_linenumber int, l_tax double, seq int")
    made.write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    text = plan(merge.upsert(lines, batch, ["l_orderkey", "l_linenumber"], ["seq"]))
    target_side = text.split("LeftAnti")[1].split("BroadcastExchange")[0]
    assert "lineitem.parquet" in target_side and "Exchange" not in target_side
