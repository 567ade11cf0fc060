"""Rolling retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F


def keep_recent(df: DataFrame, day: Column, cutoff: Column | date) -> DataFrame:
    """Drop rows older than the cutoff; rows without a date stay. The predicate prunes partitions."""
    limit = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    return df.where(day.isNull() | (day >= limit))


def retention_split(df: DataFrame, day: Column, cutoff: Column | date, by: list[Column]) -> DataFrame:
    """Rows kept and deleted per group, in one pass."""
    limit = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    old = F.coalesce(day < limit, F.lit(False))
    return df.groupBy(*by).agg(F.count_if(~old).alias("rows_kept"), F.count_if(old).alias("rows_deleted"))
