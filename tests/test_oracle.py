"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from mdlake.views import registry
from tests.compare import compare, duck

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(registry.oracles()) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, connection, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert slow not in plan, f"{name} plans a {slow}"
    n, problem = compare(df, connection, entry.oracle_sql()[name])
    assert not problem
    assert n > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
