"""Runs of consecutive positions in a group, and what is missing between them.

Positions are integers that follow each other without gaps where nothing is missing: the number of an open day
in the calendar, or of a five-minute slot. Groups are walked in range slices, and runs that cross the end of a
slice are joined, so one busy code does not become one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from . import slices
from .calendar import open_days

# Positions that one row stands for on its way to the tasks that list them.
STRETCH = 4096


def open_day_numbers(cal: DataFrame, exchange: str = "SSE") -> DataFrame:
    """(cal_date, pos): open days numbered from 1; one row per date, so one window holds them."""
    return open_days(cal, exchange).distinct().withColumn("pos", F.row_number().over(W.orderBy("cal_date")).cast("long"))


def runs(df: DataFrame, by: Sequence[str], pos: str) -> DataFrame:
    """(by, first_pos, last_pos, n_pos) of each maximal run of consecutive positions of a group.

    Repeated positions count once; rows without a position are left out.
    """
    distinct = df.where(F.col(pos).isNotNull()).select(*by, F.col(pos).cast("long").alias(pos)).distinct()
    numbered = slices.running(distinct, by, [pos], {"_n": slices.row_numbers()})
    # inside a run the position and the row number grow alike
    grouped = numbered.groupBy(*by, (F.col(pos) - F.col("_n")).alias("_run"))
    return grouped.agg(F.min(pos).alias("first_pos"), F.max(pos).alias("last_pos"), F.count(F.lit(1)).alias("n_pos")).drop("_run")


def gaps(df: DataFrame, by: Sequence[str], pos: str) -> DataFrame:
    """(by, first_pos, last_pos, n_pos) of the positions that miss between two of a group's positions."""
    distinct = df.where(F.col(pos).isNotNull()).select(*by, F.col(pos).cast("long").alias(pos)).distinct()
    before = slices.running(distinct, by, [pos], {"_before": slices.last_known(F.col(pos), itself=False)})
    holes = before.where(F.col(pos) - F.col("_before") > 1)
    return holes.select(
        *by, (F.col("_before") + 1).alias("first_pos"), (F.col(pos) - 1).alias("last_pos"), (F.col(pos) - F.col("_before") - 1).alias("n_pos")
    )


def listed(spans: DataFrame, by: Sequence[str], pos: str) -> DataFrame:
    """(by, pos): every position of spans (first_pos, last_pos). Long spans are dealt out in stretches."""
    step = F.lit(STRETCH).cast("long")
    stretches = spans.select(*by, "last_pos", F.explode(F.sequence("first_pos", "last_pos", step)).alias("_from"))
    last = F.least(F.col("_from") + STRETCH - 1, F.col("last_pos"))
    return stretches.repartition(*by, "_from").select(*by, F.explode(F.sequence("_from", last)).alias(pos))


def open_day_runs(facts: DataFrame, cal: DataFrame, by: Sequence[str], day: str, exchange: str = "SSE") -> DataFrame:
    """(by, first_day, last_day, n_days): maximal runs of consecutive open days with facts."""
    numbers = F.broadcast(open_day_numbers(cal, exchange))  # one row per date
    placed = facts.join(numbers, F.col(day) == F.col("cal_date")).select(*by, "pos")
    return (
        runs(placed, by, "pos")
        .join(numbers.select(F.col("pos").alias("first_pos"), F.col("cal_date").alias("first_day")), "first_pos")
        .join(numbers.select(F.col("pos").alias("last_pos"), F.col("cal_date").alias("last_day")), "last_pos")
        .select(*by, "first_day", "last_day", F.col("n_pos").alias("n_days"))
    )


def missing_open_days(facts: DataFrame, cal: DataFrame, by: Sequence[str], day: str, exchange: str = "SSE") -> DataFrame:
    """(by, day): open days without facts between a group's first and last day."""
    numbers = F.broadcast(open_day_numbers(cal, exchange))  # one row per date
    placed = facts.join(numbers, F.col(day) == F.col("cal_date")).select(*by, "pos")
    return listed(gaps(placed, by, "pos"), by, "pos").join(numbers, "pos").select(*by, F.col("cal_date").alias(day))
