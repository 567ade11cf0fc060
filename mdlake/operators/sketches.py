"""Distinct counts and quantiles per partition as small stored states that merge.

A state of a day stays as it is once the day is complete; a month, a year or any other union of days is read
from the days' states, and new days are added without reading old rows again. Distinct counts are HyperLogLog
states (relative standard error about 1.04 / sqrt(2^lg_k) / 1.2 in its compact form, 1.6 % at the default),
quantiles are KLL states (rank error about 1.7 % at the default k = 200).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LG_K = 12
KLL_K = 200


def states(df: DataFrame, by: Sequence[str], distinct: dict[str, str], quantile: dict[str, str]) -> DataFrame:
    """(by, n_rows, one state per output): ``distinct`` and ``quantile`` map outputs to columns.

    States are made on the map side, so a hot partition ships one state per task. Nulls do not count; a group
    without values has null states. Quantile columns are read as doubles.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.when(F.count(c) > 0, F.hll_sketch_agg(c, F.lit(LG_K))).alias(out) for out, c in distinct.items()),
        *(F.when(F.count(c) > 0, F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K))).alias(out) for out, c in quantile.items()),
    )


def merged(stored: DataFrame, by: Sequence[str], distinct: Sequence[str], quantile: Sequence[str]) -> DataFrame:
    """States of coarser groups from stored ones, in the same form, so that they can be stored and merged again."""
    return stored.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        *(F.when(F.count(c) > 0, F.hll_union_agg(c, F.lit(False))).alias(c) for c in distinct),
        *(F.when(F.count(c) > 0, F.kll_merge_agg_double(c, F.lit(KLL_K))).alias(c) for c in quantile),
    )


def estimates(stored: DataFrame, distinct: Sequence[str], quantile: Sequence[str], ranks: Sequence[float]) -> DataFrame:
    """States replaced by numbers: a distinct count, or an array of the quantiles at ``ranks``."""
    wanted = F.array(*(F.lit(float(r)) for r in ranks))
    return stored.withColumns(
        {
            **{c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0).cast("long")) for c in distinct},
            **{c: F.kll_sketch_get_quantile_double(c, wanted) for c in quantile},
        }
    )
