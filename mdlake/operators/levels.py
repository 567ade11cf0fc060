"""Grouping sets, cube and rollup with distinct counts, from one pre-aggregated input.

The input is read and shuffled once, down to one row per combination of all dimensions and distinct value. Only
those rows are repeated for the levels, and a level's distinct values are counted after equal ones have met, so
the distinct count costs no further pass over the input. Sums of a hot combination are made before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

LEVEL = "level"


def cube(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """Every subset of the dimensions, the largest first."""
    return [c for n in range(len(dimensions), -1, -1) for c in combinations(dimensions, n)]


def rollup(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """Every prefix of the dimensions, the longest first."""
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def grouping_sets(
    df: DataFrame, levels: Sequence[Sequence[str]], sums: dict[str, Column], distinct: str, n_distinct: str, n_rows: str = "n_rows"
) -> DataFrame:
    """One row per level and group: ``level`` (the names of its dimensions), the dimensions, sums, number of rows
    and number of distinct non-null values of ``distinct``.

    A dimension outside of a row's level is null; a null inside of one is a group of its own, told apart by
    ``level``. An empty table has no groups, at the level without dimensions either.
    """
    dimensions = list(dict.fromkeys(d for level in levels for d in level))
    base = df.groupBy(*dimensions, F.col(distinct).alias("_value")).agg(
        *(F.sum(c).alias(name) for name, c in sums.items()), F.count(F.lit(1)).alias(n_rows)
    )
    kinds = {d: df.schema[d].dataType for d in dimensions}
    copies = F.array(
        *(
            F.struct(
                F.lit(",".join(level)).alias(LEVEL),
                *((F.col(d) if d in level else F.lit(None).cast(kinds[d])).alias(d) for d in dimensions),
            )
            for level in levels
        )
    )
    measures = [*sums, n_rows]
    spread = base.select(F.explode(copies).alias("_g"), "_value", *measures).select("_g.*", "_value", *measures)
    keys = [LEVEL, *dimensions]
    met = spread.groupBy(*keys, "_value").agg(*(F.sum(m).alias(m) for m in measures))
    return met.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures), F.count("_value").alias(n_distinct))
