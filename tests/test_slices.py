"""Running values over sliced groups against plain loops."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
import pytest

from mdlake.operators import slices


@pytest.fixture
def many_slices(spark):
    """Small shuffles stay cut into as many slices as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def by_hand(rows):
    want = []
    for code in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == code), key=lambda r: r[1])
        last, xor = None, 0
        for n, (_, at, value) in enumerate(group, 1):
            last = last if value is None else value
            xor ^= at * 7
            want.append((code, at, n, xor, last))
    return want


def test_running_values_of_one_hot_group_and_a_null_group(spark, many_slices):
    random.seed(3)
    rows = [("hot", i, random.choice([None, i])) for i in random.sample(range(5000), 3000)]
    rows += [(c, i, random.choice([None, -i])) for c in ("a", "b", None) for i in random.sample(range(50), 20)]
    df = spark.createDataFrame(rows, "code string, at long, value long")
    cut = slices.sliced(df, ["code"], ["at"])
    spread = cut.where("code = 'hot'").select(slices.SLICE).distinct().count()
    assert spread > 1
    outputs = {
        "n": slices.row_numbers(),
        "x": slices.running_xor(F.col("at") * 7),
        "last": slices.last_known(F.col("value")),
    }
    got = slices.run(cut, ["code"], ["at"], outputs)
    assert got.columns == ["code", "at", "value", "n", "x", "last"]
    found = [(r["code"], r["at"], r["n"], r["x"], r["last"]) for r in got.collect()]
    assert sorted(found, key=str) == sorted(by_hand(rows), key=str)


def test_running_values_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "code string, at long")
    assert slices.running(df, ["code"], ["at"], {"n": slices.row_numbers()}).collect() == []
