"""Days inside periods with open ends, without a join on a range.

A period is cut to the days that occur and into blocks: runs of 64^(k+1) days that start at a multiple of that. Its
ends lie in blocks of 64 days, which they may fill in part, and blocks of higher levels are used only inside of
it. A day lies in one block of each level, so days and periods meet in an equi-join on (code, level, block), each pair in
exactly one block, and a comparison drops the days of a block outside of the period. A day is repeated once for each
level that can occur, which is one level unless the days span more than 64 blocks. A code with very many days
spreads over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from . import slices
from .asof import asof_join

# Days are counted from this many days before 1970, so that all dates from year 1 to 9999 have positive numbers.
ORIGIN = 1 << 20
# A block holds 2^BITS blocks of the level below; the highest level's hold all dates.
BITS, LEVELS = 6, 4


def day_number(day: Column) -> Column:
    return F.unix_date(day).cast("long") + ORIGIN


def levels_within(first: int, last: int) -> int:
    """How many levels have a block that can lie inside the days ``first`` to ``last``, the lowest level included."""
    begin, end, levels = first >> BITS, (last >> BITS) + 1, 1
    while levels < LEVELS and (begin := -(-begin >> BITS)) < (end := end >> BITS):
        levels += 1
    return levels


def blocks_of_day(number: Column, levels: int) -> Column:
    """(level, block) of the block of each level that holds a day."""
    return F.array(
        *(F.struct(F.lit(k).alias("level"), F.shiftright(number, BITS * (k + 1)).alias("block")) for k in range(levels))
    )


def blocks_of_period(first: Column, last: Column, lowest: int, highest: int) -> Column:
    """(level, block) of the fewest blocks that hold the days ``first`` to ``last``; null ends are open.

    Days outside of ``lowest`` to ``highest`` are left out. An empty period has no blocks.
    """
    low = F.greatest(F.coalesce(day_number(first), F.lit(lowest)), F.lit(lowest)).cast("long")
    high = F.least(F.coalesce(day_number(last), F.lit(highest)), F.lit(highest)).cast("long")
    alive = low <= high
    begin, end = F.shiftright(low, BITS), F.shiftright(high, BITS) + 1
    levels, found = levels_within(lowest, highest), []
    for k in range(levels):
        above, below = F.shiftright(begin + ((1 << BITS) - 1), BITS), F.shiftright(end, BITS)
        rises = (above < below) if k + 1 < levels else F.lit(False)
        found.append(_blocks(k, alive, begin, F.when(rises, F.shiftleft(above, BITS)).otherwise(end)))
        if k + 1 < levels:
            found.append(_blocks(k, alive & rises, F.shiftleft(below, BITS), end))
        alive, begin, end = alive & rises, above, below
    return F.flatten(F.array(*found))


def _blocks(level: int, wanted: Column, begin: Column, end: Column) -> Column:
    """Blocks from ``begin`` up to but not including ``end``."""
    numbers = F.when(wanted & (begin < end), F.sequence(begin, end - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(numbers, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))


def interval_join(points: DataFrame, periods: DataFrame, by: Sequence[str], day: str, start: str, end: str) -> DataFrame:
    """Every pair of a point and a period of the same group whose days, ends included, hold the point's day.

    Columns of both sides follow each other; apart from ``by`` their names must differ. A null group or day
    matches nothing, a period that ends before it starts holds no day.
    """
    clash = set(points.columns) & set(periods.columns) - set(by)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    number = day_number(F.col(day))
    lowest, highest = points.agg(F.min(number), F.max(number)).first()
    if lowest is None:
        return points.withColumns({c: F.lit(None).cast(periods.schema[c].dataType) for c in periods.columns if c not in by}).limit(0)
    cut = periods.withColumn("_b", F.explode(blocks_of_period(F.col(start), F.col(end), lowest, highest)))
    placed = points.where(F.col(day).isNotNull()).withColumn("_b", F.explode(blocks_of_day(number, levels_within(lowest, highest))))
    cut, placed = (df.withColumns({"_level": F.col("_b.level"), "_block": F.col("_b.block")}).drop("_b") for df in (cut, placed))
    inside = (F.col(start).isNull() | (F.col(day) >= F.col(start))) & (F.col(end).isNull() | (F.col(day) <= F.col(end)))
    return placed.join(cut, [*by, "_level", "_block"]).where(inside).select(
        *points.columns, *(c for c in periods.columns if c not in by)
    )


def merged_periods(periods: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """(by, start, end): periods of a group that overlap or follow each other day by day become one.

    Groups are walked in range slices. Null ends are open, empty periods vanish.
    """
    first, last = F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")
    whole = (
        periods.select(*by, F.coalesce(start, first).alias("_s"), F.coalesce(end, last).alias("_e"))
        .where(F.col("_s") <= F.col("_e"))
        .groupBy(*by, "_s")
        .agg(F.max("_e").alias("_e"))
    )
    reach = slices.running(whole, by, ["_s"], {"_until": slices.running_max(F.col("_e"), itself=False)})
    fresh = F.col("_until").isNull() | (F.datediff("_s", "_until") > 1)
    numbered = slices.running(reach.withColumn("_new", fresh.cast("int")), by, ["_s"], {"_run": slices.running_sum(F.col("_new"))})
    return numbered.groupBy(*by, "_run").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")).select(
        *by, F.when(F.col("_s") > first, F.col("_s")).alias(start), F.when(F.col("_e") < last, F.col("_e")).alias(end)
    )


def covered(points: DataFrame, periods: DataFrame, by: Sequence[str], day: str, start: str, end: str) -> DataFrame:
    """Points with ``covered``: whether a period of their group holds their day. Rows stay as many as they are.

    Merged periods do not overlap, so the newest one that has begun decides, which is an as-of join.
    """
    joined = merged_periods(periods, by, start, end).select(
        *by, F.coalesce(start, F.lit("0001-01-01").cast("date")).alias("_from"), F.coalesce(end, F.lit("9999-12-31").cast("date")).alias("_to")
    )
    found = asof_join(points, joined, by, day, "_from")
    return found.withColumn("covered", F.coalesce(F.col(day) <= F.col("_to"), F.lit(False))).drop("_from", "_to")
