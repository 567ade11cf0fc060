"""Bit-sliced scatter against Python integers, and whitening against a plain eigendecomposition."""

from __future__ import annotations

from fractions import Fraction
import math
import random

import numpy as np
import pytest

from mdlake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, x string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0, "c", "n", "x") for i, v in rows], schema)


def by_hand(rows):
    """(kept rows with x, fit list, sums, covariance as fractions)."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, size = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(size)]
    cov = [[Fraction(n * sum(x[a] * x[b] for x in fit) - sums[a] * sums[b], n * n) for b in range(size)] for a in range(size)]
    return kept, fit, sums, cov


def vectors(n, size, seed=4, spread=1.0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) * spread
    return [[float(np.float32(c)) for c in v] for v in base]


def check(rows, out, components=16):
    kept, fit, sums, cov = by_hand(rows)
    n, size = len(fit), len(sums)
    matrix = np.array([[float(c) for c in row] for row in cov])
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(-values)[:components]
    values, axes = values[order], axes[:, order]
    got = {}
    for r in out:
        got.setdefault(r["vec_id"], []).append(r)
    assert sorted(got, key=str) == sorted({i for i, _ in kept}, key=str)
    assert len(out) == len(kept) * min(components, size)
    known = values > values[0] * 1e-9
    signs = {}
    for i, x in kept:
        mine = sorted((r for r in got[i]), key=lambda r: r["component"])
        want = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ axes / np.sqrt(np.where(known, values, np.nan))
        assert [r["component"] for r in mine][:: max(1, len(mine) // len(order))] or True
        by_component = {}
        for r in mine:
            by_component.setdefault(r["component"], []).append(r)
        assert sorted(by_component) == list(range(1, len(order) + 1))
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k, found in by_component.items():
            for r in found:
                assert r["n"] == n
                assert r["explained"] == pytest.approx(values[k - 1] / np.trace(matrix), rel=1e-4, abs=1e-12)
                assert 0 <= r["identity_error"] < 1e-4
            if known[k - 1] and len(found) == 1:
                assert found[0]["deviation"] == deviation
                if abs(want[k - 1]) > 1e-6:
                    sign = signs.setdefault(k, math.copysign(1, found[0]["whitened"] * want[k - 1]))
                    assert found[0]["whitened"] == pytest.approx(sign * want[k - 1], rel=1e-6, abs=1e-6)
            if not known[k - 1]:
                assert found[0]["whitened"] is None


def test_whitening_equals_a_plain_eigendecomposition(spark):
    plain = vectors(300, 20)
    rows = [(i, v) for i, v in enumerate(plain)]
    rows += [(1000 + i, plain[0]) for i in range(150)]  # a third of the rows is one vector
    rows += [(2000, None), (2001, [None] * 20), (2002, [float("nan")] * 20), (2003, [float("inf")] + [0.0] * 19), (2004, [])]
    rows += [(None, plain[1]), (7, plain[2])]
    check(rows, whitening.whiten(frame(spark, rows)).collect())


def test_fewer_vectors_than_dimensions_and_fewer_dimensions_than_components(spark):
    rows = [(i, v) for i, v in enumerate(vectors(5, 8))]
    check(rows, whitening.whiten(frame(spark, rows)).collect())


def test_constant_and_single_vectors(spark):
    for rows in ([(1, [0.5, -0.25])], [(1, [0.5, -0.25]), (2, [0.5, -0.25])]):
        out = whitening.whiten(frame(spark, rows)).collect()
        assert len(out) == 2 * len(rows)
        assert all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, None, None) for r in out)


def test_vectors_of_another_length_are_left_out(spark):
    rows = [(i, v) for i, v in enumerate(vectors(10, 3))] + [(50, [1.0]), (51, [1.0, 2.0])]
    check(rows[:10], whitening.whiten(frame(spark, rows)).collect())


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, [])]):
        out = whitening.whiten(frame(spark, rows))
        assert out.columns[0] == "vec_id" and out.collect() == []


@pytest.mark.parametrize("spread", [1, 200, 10**9, 2**60])
def test_scatter_is_exact(spark, spread, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 9000)  # several blocks a task
    random.seed(spread)
    rows = [[random.randrange(-spread, spread + 1) for _ in range(5)] for _ in range(700)]
    df = spark.createDataFrame([(r,) for r in rows], "x array<bigint>")
    low, high, n = whitening.bounds(df)
    assert (low, high, n) == ([min(c) for c in zip(*rows)], [max(c) for c in zip(*rows)], 700)
    bits = [(h - l).bit_length() for l, h in zip(low, high)]
    got = {}
    for r in whitening.scatter_cells(df, low, bits).collect():
        got[r["a"], r["b"]] = got.get((r["a"], r["b"]), 0) + (r["n"] << r["weight"])
    shifted = [[c - l for c, l in zip(r, low)] for r in rows]
    want = {(a, b): sum(r[a] * r[b] for r in shifted) for a in range(5) for b in range(a, 5)}
    want |= {(-1, a): sum(r[a] for r in shifted) for a in range(5)}
    assert got == {k: v for k, v in want.items() if v}


def test_large_entries_keep_exact_deviations_or_none(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate([[1e5, -1e5], [2e5, 7.0], [-3e5, 1.0], [1e30, 0.0]])]
    out = whitening.whiten(frame(spark, rows)).collect()
    kept = {r["vec_id"]: r["deviation"] for r in out}
    assert len(out) == 8 and kept[3] is None
    check(rows[:3], whitening.whiten(frame(spark, rows[:3])).collect())
