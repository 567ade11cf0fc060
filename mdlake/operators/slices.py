"""Running values over ordered groups of any size.

A window over a group sorts the whole group in one task. Here rows are range-partitioned by (group, order)
into slices, so a group with very many rows spreads over many tasks; a value runs inside each slice and
continues from what the group's earlier slices left, of which there is one row per slice and group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import checkpointed

SLICE = "_slice"


@dataclass(frozen=True)
class Running:
    """How a value runs on: ``inside`` aggregates rows in their order, ``across`` the results of earlier slices
    in theirs, and ``join`` puts the earlier result (null in a group's first slice) and the slice's own together.

    ``total`` is a whole slice's result, of rows in no order, given their order as a column; if it is not named,
    ``inside`` does not depend on the order. Without ``itself`` a row gets the value before it."""

    inside: Callable[[], Column]
    across: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]
    total: Callable[[Column], Column] | None = None
    itself: bool = True


def row_numbers() -> Running:
    """1-based position in the group."""
    return Running(lambda: F.count(F.lit(1)), F.sum, lambda before, own: F.coalesce(before, F.lit(0)) + own)


def running_sum(value: Column) -> Running:
    return Running(lambda: F.sum(value), F.sum, lambda before, own: F.coalesce(before, F.lit(0)) + F.coalesce(own, F.lit(0)))


def running_max(value: Column, itself: bool = True) -> Running:
    """Nulls do not count; null as long as there is nothing else."""
    return Running(lambda: F.max(value), F.max, lambda before, own: F.greatest(before, own), None, itself)


def running_xor(value: Column) -> Running:
    return Running(lambda: F.bit_xor(value), F.bit_xor, lambda before, own: F.coalesce(before, F.lit(0)).bitwiseXOR(own))


def last_known(value: Column, itself: bool = True) -> Running:
    """The newest value so far that is not null."""
    return Running(
        lambda: F.last(value, ignorenulls=True),
        lambda earlier: F.last(earlier, ignorenulls=True),
        lambda before, own: F.coalesce(own, before),
        lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        itself,
    )


def sliced(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with the number of their slice; slices follow (by, order), and rows that tie share a slice.

    The frame is checkpointed, as later passes must see the same slices.
    """
    return checkpointed(df.repartitionByRange(*by, *order).withColumn(SLICE, F.spark_partition_id()))


def run(
    cut: DataFrame, by: Sequence[str], order: Sequence[str], outputs: dict[str, Running], keep_slice: bool = False
) -> DataFrame:
    """Adds one running value per output to a frame from ``sliced``.

    ``keep_slice`` keeps the slices' numbers, so that further values, which may depend on these, run over the same slices.

    Null groups are groups of their own. Rows that tie in the order get values in an arbitrary order.
    """
    rows = W.partitionBy(*by, SLICE).orderBy(*order)
    until = {True: W.currentRow, False: -1}
    place = F.struct(*order)
    totals = cut.groupBy(*by, SLICE).agg(
        *((r.total(place) if r.total else r.inside()).alias(f"_slice_total_{name}") for name, r in outputs.items())
    )
    earlier = W.partitionBy(*by).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    left = totals.select(
        *(F.col(b).alias(f"_slice_by_{b}") for b in by),
        F.col(SLICE).alias("_slice_of"),
        *(r.across(F.col(f"_slice_total_{name}")).over(earlier).alias(f"_slice_before_{name}") for name, r in outputs.items()),
    )
    same = F.col(SLICE) == F.col("_slice_of")
    for b in by:
        same &= F.col(b).eqNullSafe(F.col(f"_slice_by_{b}"))
    inside = cut.withColumns({f"_slice_own_{name}": r.inside().over(rows.rowsBetween(W.unboundedPreceding, until[r.itself])) for name, r in outputs.items()})
    return (
        inside.join(left, same, "left")
        .withColumns({name: r.join(F.col(f"_slice_before_{name}"), F.col(f"_slice_own_{name}")) for name, r in outputs.items()})
        .drop(
            "_slice_of",
            *([] if keep_slice else [SLICE]),
            *(f"_slice_by_{b}" for b in by),
            *(f"_slice_{k}_{name}" for name in outputs for k in ("before", "own")),
        )
    )


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], outputs: dict[str, Running]) -> DataFrame:
    return run(sliced(df, by, order), by, order, outputs)
