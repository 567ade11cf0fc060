"""Aggregates over the last N calendar days of a group.

Days have gaps, so the frame is a range of days and not a number of rows. A group's days are cut into slices of
``slice_days``; each slice also gets the rows of the N - 1 days before it, its halo. A window then runs inside
(group, slice), and halo rows are dropped. So a group with a third of all rows is one task per slice, and the
halo adds at most (N - 1) / slice_days of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

PART, HALO, DAY = "_part", "_halo", "_day"


def over_days(
    df: DataFrame, by: Sequence[str], day: str, n_days: int, outputs: dict[str, Column], slice_days: int | None = None
) -> DataFrame:
    """Adds aggregates of the rows of a row's group whose day lies in the last ``n_days`` days up to its own.

    Rows of the same day see each other. Rows without a day see those without a day. ``slice_days`` is at least
    ``n_days`` - 1 and by default four times as long; null groups are groups of their own.
    """
    if n_days < 1:
        raise ValueError("a frame has at least one day")
    span = max(slice_days or 4 * n_days, n_days - 1, 1)
    number = F.unix_date(F.col(day))
    own = F.floor(number / span)
    last_days = number >= (own + 1) * span - (n_days - 1)
    parts = F.when(last_days, F.array(F.struct(own.alias("p"), F.lit(False).alias("h")), F.struct((own + 1).alias("p"), F.lit(True).alias("h"))))
    spread = df.withColumn("_in", F.explode(F.coalesce(parts, F.array(F.struct(own.alias("p"), F.lit(False).alias("h")))))).withColumns(
        {PART: F.col("_in.p"), HALO: F.col("_in.h"), DAY: number}
    )
    frame = W.partitionBy(*by, PART).orderBy(DAY).rangeBetween(-(n_days - 1), W.currentRow)
    seen = spread.withColumns({name: c.over(frame) for name, c in outputs.items()})
    return seen.where(~F.col(HALO)).drop("_in", PART, HALO, DAY)
