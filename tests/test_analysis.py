"""As-of joins, periods, differences, frames, runs and levels against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import date, timedelta
import random

from pyspark.sql import functions as F
import pytest

from mdlake.operators import asof, difference, frames, intervals, islands, levels, slices

D0 = date(2024, 1, 1)


def day(n):
    return None if n is None else D0 + timedelta(days=n)


@pytest.fixture
def many_slices(spark):
    """Small shuffles stay cut into as many slices as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# --- as-of --------------------------------------------------------------------------------------------


def asof_by_hand(left, right, strict, within):
    out = []
    for code, at, x in left:
        best = None
        for c, t, rank, factor in right:
            if code is None or c != code or at is None or t is None or not (t < at if strict else t <= at):
                continue
            if best is None or (t, rank) > best[:2]:
                best = (t, rank, factor)
        if best and within is not None and (at - best[0]).days > within:
            best = None
        out.append((code, at, x, best[0] if best else None, best[2] if best else None))
    return Counter(out)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("within", [None, 3])
def test_asof_join(spark, many_slices, strict, within):
    random.seed(7)
    codes = ["hot"] * 6 + ["a", "b", None]
    left = [(random.choice(codes), day(random.choice([*range(60), None])), i) for i in range(400)]
    left += left[:5]
    right = [(random.choice(codes), day(random.choice([*range(0, 60, 4), None])), i, random.choice([None, i])) for i in range(150)]
    a = spark.createDataFrame(left, "code string, at date, x long")
    b = spark.createDataFrame(right, "code string, since date, rank long, factor long")
    limit = None if within is None else F.make_dt_interval(F.lit(within))
    got = asof.asof_join(a, b, ["code"], "at", "since", strict, limit, ["rank"])
    assert got.columns == ["code", "at", "x", "since", "factor"]
    assert rows_of(got) == asof_by_hand(left, right, strict, within)


def test_asof_join_of_empty_sides_and_clashing_names(spark):
    a = spark.createDataFrame([("a", D0, 1)], "code string, at date, x long")
    b = spark.createDataFrame([("a", D0, 2)], "code string, at date, x long")
    assert rows_of(asof.asof_join(a, b, ["code"], "at", prefix="r_")) == Counter([("a", D0, 1, D0, 2)])
    assert rows_of(asof.asof_join(a, b.limit(0), ["code"], "at", prefix="r_")) == Counter([("a", D0, 1, None, None)])
    assert asof.asof_join(a.limit(0), b, ["code"], "at", prefix="r_").collect() == []
    with pytest.raises(ValueError, match="both sides"):
        asof.asof_join(a, b, ["code"], "at")


# --- periods ------------------------------------------------------------------------------------------


def periods_of(n, seed, codes=("hot", "hot", "hot", "a", None)):
    random.seed(seed)
    out = []
    for _ in range(n):
        start = random.choice([None, *range(200)])
        end = random.choice([None, *range((start or 0) - 2, (start or 0) + random.choice([3, 40, 150]))])
        out.append((random.choice(codes), day(start), day(end)))
    return out


def holds(period, code, at):
    c, s, e = period
    return c is not None and c == code and at is not None and (s is None or s <= at) and (e is None or at <= e)


def test_interval_join_and_cover(spark, many_slices):
    periods = periods_of(60, 3)
    points = [(random.choice(["hot", "a", "b", None]), day(random.choice([None, *range(-5, 260)])), i) for i in range(300)]
    p = spark.createDataFrame(points, "code string, at date, x long")
    q = spark.createDataFrame(periods, "code string, s date, e date")
    got = intervals.interval_join(p, q, ["code"], "at", "s", "e")
    assert rows_of(got) == Counter((*x, *y[1:]) for x in points for y in periods if holds(y, x[0], x[1]))
    flagged = intervals.covered(p, q, ["code"], "at", "s", "e")
    assert rows_of(flagged) == Counter((*x, any(holds(y, x[0], x[1]) for y in periods)) for x in points)


def test_blocks_of_extreme_periods_cover_each_day_once(spark):
    rows = [(None, None), (date(1, 1, 1), date(1, 1, 1)), (date(9999, 12, 31), None), (D0, D0), (D0, D0 - timedelta(days=1)), (None, D0)]
    q = spark.createDataFrame([("a", *r) for r in rows], "code string, s date, e date")
    days = [date(1, 1, 1), date(1969, 12, 31), D0, D0 + timedelta(days=1), date(9999, 12, 31)]
    p = spark.createDataFrame([("a", d) for d in days], "code string, at date")
    got = intervals.interval_join(p, q, ["code"], "at", "s", "e")
    assert rows_of(got) == Counter(("a", d, *r) for d in days for r in rows if holds(("a", *r), "a", d))


def test_open_ends_do_not_repeat_the_days(spark):
    """Days of a few years are joined once each, however long the periods are; longer spans use few levels."""
    numbers = [intervals.ORIGIN + n for n in (9000, 9000 + 2500)]
    assert intervals.levels_within(*numbers) == 1
    days = [D0 + timedelta(days=n) for n in (0, 63, 64, 2000, 300_000)]
    rows = [(None, None), (days[0], None), (None, days[3]), (days[1], days[2]), (days[2] + timedelta(days=1), days[4] - timedelta(days=1))]
    p = spark.createDataFrame([("a", d) for d in days], "code string, at date")
    q = spark.createDataFrame([("a", *r) for r in rows], "code string, s date, e date")
    got = intervals.interval_join(p, q, ["code"], "at", "s", "e")
    assert rows_of(got) == Counter(("a", d, *r) for d in days for r in rows if holds(("a", *r), "a", d))
    low, high = intervals.ORIGIN + 9000, intervals.ORIGIN + 309_000
    blocks = intervals.blocks_of_period(F.col("s"), F.col("e"), low, high)
    one = spark.createDataFrame([(None, None)], "s date, e date").select(F.explode(blocks).alias("b")).select("b.*")
    covers = sorted((b << 6 * (k + 1), (b + 1) << 6 * (k + 1)) for k, b in one.collect())
    assert covers[0][0] <= low and covers[-1][1] > high and all(x[1] == y[0] for x, y in zip(covers, covers[1:]))
    assert len(covers) < 5 * 2 * 64


def test_merged_periods(spark, many_slices):
    periods = periods_of(40, 9)
    q = spark.createDataFrame(periods, "code string, s date, e date")
    got = intervals.merged_periods(q, ["code"], "s", "e").collect()
    span = range(-10, 400)
    for code in ("hot", "a"):
        mine = [(r["code"], r["s"], r["e"]) for r in got if r["code"] == code]
        for n in span:
            assert sum(holds(m, code, day(n)) for m in mine) == any(holds(y, code, day(n)) for y in periods)
        ends = sorted(((s or date.min), (e or date.max)) for _, s, e in mine)
        assert all((b[0] - a[1]).days > 1 for a, b in zip(ends, ends[1:]))


def test_no_periods(spark):
    p = spark.createDataFrame([("a", D0)], "code string, at date")
    q = spark.createDataFrame([], "code string, s date, e date")
    assert intervals.interval_join(p, q, ["code"], "at", "s", "e").collect() == []
    assert rows_of(intervals.covered(p, q, ["code"], "at", "s", "e")) == Counter([("a", D0, False)])


# --- differences --------------------------------------------------------------------------------------


def multisets(seed):
    random.seed(seed)
    values = [None, 0, 1, 2]
    old = [(random.choice(values), random.choice(["x", None, "y"]), random.choice([0.0, 1.5, None])) for _ in range(200)]
    new = old[20:] + [random.choice(old) for _ in range(30)] + [(9, "new", 0.0)]
    return old + [(1, "hot", 1.0)] * 100, new + [(1, "hot", 1.0)] * 90


@pytest.mark.parametrize("buckets", [1, 16])
def test_multiset_differences(spark, buckets):
    old, new = multisets(4)
    schema = "a long, b string, c double"
    x, y = (spark.createDataFrame(rows, schema) for rows in (old, new))
    gone, come = Counter(old) - Counter(new), Counter(new) - Counter(old)
    assert rows_of(difference.except_all(x, y, buckets)) == gone
    assert rows_of(difference.intersect_all(x, y, buckets)) == Counter(old) & Counter(new)
    want = Counter([(*r, "deleted", n) for r, n in gone.items()] + [(*r, "inserted", n) for r, n in come.items()])
    assert rows_of(difference.row_changes(x, y, buckets)) == want
    assert difference.row_changes(x, x, buckets).collect() == []
    assert rows_of(difference.except_all(x, y.limit(0), buckets)) == Counter(old)
    assert rows_of(difference.row_changes(y, x.select("c", "b", "a"), buckets)) == Counter(
        [(*r, "inserted", n) for r, n in gone.items()] + [(*r, "deleted", n) for r, n in come.items()]
    )


def test_swapped_nulls_and_even_copies_change_a_bucket(spark):
    pairs = [([(None, "x")], [("x", None)]), ([("a", "a")] * 2, [("b", "b")] * 2), ([("a", None)], [(None, "a")])]
    for old, new in pairs:
        x, y = (spark.createDataFrame(rows, "a string, b string") for rows in (old, new))
        assert rows_of(difference.except_all(x, y, 1)) == Counter(old)


def test_only_differing_buckets_are_compared(spark):
    x = spark.range(2000).select("id", F.lit("v").alias("v"))
    y = x.withColumn("v", F.when(F.col("id") == 7, "w").otherwise(F.col("v")))
    wanted = difference.differing_buckets(difference.bucket_digests(x, ["id"], 64), difference.bucket_digests(y, ["id"], 64))
    assert wanted.count() == 1
    found = difference.keyed_changes(x, y, ["id"], 64).collect()
    assert [(r["id"], r["change"], r["old"]["v"], r["new"]["v"]) for r in found] == [(7, "changed", "v", "w")]


def test_keyed_changes(spark):
    old = [(1, "a", 1.0), (2, "b", None), (None, "c", 3.0), (4, "d", 4.0)]
    new = [(1, "a", 1.0), (2, "b", 2.0), (None, "c", 5.0), (5, "e", 5.0)]
    x, y = (spark.createDataFrame(rows, "k long, n string, v double") for rows in (old, new))
    got = {(r["k"], r["n"]): (r["change"], r["old"] and r["old"]["v"], r["new"] and r["new"]["v"]) for r in difference.keyed_changes(x, y, ["k", "n"]).collect()}
    assert got == {
        (2, "b"): ("changed", None, 2.0), (None, "c"): ("changed", 3.0, 5.0),
        (4, "d"): ("deleted", 4.0, None), (5, "e"): ("inserted", None, 5.0),
    }


# --- frames -------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("n_days", "slice_days"), [(1, None), (7, None), (7, 6), (30, 31), (365, None)])
def test_frames_over_days(spark, n_days, slice_days):
    random.seed(n_days)
    rows = [(random.choice(["hot", "hot", "a", None]), day(random.choice([*range(-40, 200), None])), i) for i in range(300)]
    df = spark.createDataFrame(rows, "code string, at date, x long")
    outputs = {"n": F.count(F.lit(1)), "s": F.sum("x"), "low": F.min("x")}
    got = frames.over_days(df, ["code"], "at", n_days, outputs, slice_days)
    want = Counter()
    for code, at, x in rows:
        seen = [z for c, d, z in rows if c == code and (d is None if at is None else d is not None and 0 <= (at - d).days < n_days)]
        want[code, at, x, len(seen), sum(seen), min(seen)] += 1
    assert got.columns == ["code", "at", "x", "n", "s", "low"] and rows_of(got) == want


def test_a_hot_group_is_cut_into_slices(spark):
    df = spark.createDataFrame([("hot", day(i)) for i in range(400)], "code string, at date")
    plan = frames.over_days(df, ["code"], "at", 10, {"n": F.count(F.lit(1))})._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning(code" in plan and frames.PART in plan.split("hashpartitioning(code", 1)[1][:60]


# --- runs ---------------------------------------------------------------------------------------------


def test_runs_gaps_and_missing_positions(spark, many_slices, monkeypatch):
    monkeypatch.setattr(islands, "STRETCH", 3)
    random.seed(11)
    rows = [("hot", p) for p in random.sample(range(3000), 2200)] + [("a", p) for p in (5, 6, 6, 9, -3)] + [(None, 1), (None, 2), ("b", None)]
    df = spark.createDataFrame(rows, "code string, pos long")
    runs, missing = Counter(), Counter()
    for code in {c for c, p in rows if p is not None}:
        mine = sorted({p for c, p in rows if c == code and p is not None})
        start = mine[0]
        for a, b in zip(mine, [*mine[1:], None]):
            if b != a + 1:
                runs[code, start, a, a - start + 1] += 1
                start = b
                missing.update((code, p) for p in range(a + 1, b or 0))
    assert rows_of(islands.runs(df, ["code"], "pos")) == runs
    assert rows_of(islands.listed(islands.gaps(df, ["code"], "pos"), ["code"], "pos")) == missing


def test_running_values_without_the_row_itself(spark, many_slices):
    rows = [("a", i, random.choice([None, i])) for i in random.sample(range(900), 500)]
    df = spark.createDataFrame(rows, "code string, at long, v long")
    outputs = {"before": slices.last_known(F.col("v"), itself=False), "top": slices.running_max(F.col("v"), itself=False), "sum": slices.running_sum(F.col("v"))}
    last, top, total = None, None, 0
    want = set()
    for code, at, v in sorted(rows, key=lambda r: r[1]):
        total += v or 0
        want.add((code, at, v, last, top, total))
        if v is not None:
            last, top = v, v if top is None else max(top, v)
    assert set(rows_of(slices.running(df, ["code"], ["at"], outputs))) == want


# --- levels -------------------------------------------------------------------------------------------


def test_grouping_sets(spark):
    random.seed(6)
    rows = [(random.choice(["a", "b", None]), random.choice([1, 2, None]), random.choice([None, "u", "v", "w"]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "x string, y long, user string, n long")
    for wanted in (levels.cube(["x", "y"]), levels.rollup(["y", "x"]), [("x",), ()]):
        groups = defaultdict(list)
        for r in rows:
            for level in wanted:
                groups[(",".join(level), *(r["xy".index(d)] if d in level else None for d in dict.fromkeys(d for lv in wanted for d in lv)))].append(r)
        want = Counter((*g, sum(r[3] for r in v), len(v), len({r[2] for r in v} - {None})) for g, v in groups.items())
        got = levels.grouping_sets(df, wanted, {"total": F.col("n")}, "user", "n_users")
        assert rows_of(got) == want
    assert levels.grouping_sets(df.limit(0), levels.cube(["x"]), {}, "user", "n").collect() == []
