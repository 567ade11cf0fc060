"""As-of join: the newest known row of another table at a row's time.

Both sides are put into one stream ordered by (code, time) and cut into range slices, so neither the prices of
one busy code nor its factors have to fit one task. The last row of the other side is carried inside each
slice and over slice ends. There is no join on a range, and nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from . import slices
from .merge import last_per_key

SIDE, ROW, FOUND = "_side", "_row", "_found"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    at: str,
    right_at: str | None = None,
    strict: bool = False,
    within: Column | None = None,
    order: Sequence[str] = (),
    prefix: str = "",
) -> DataFrame:
    """Every row of ``left`` with the columns of the newest ``right`` row of its group at or before its time.

    ``strict`` takes only earlier rows; ``within`` (an interval) only rows that are not older. Of several right
    rows of one group and time the last by ``order`` counts; without ``order`` they must be unique. ``prefix``
    goes before the names of the right columns, the right time included, which is named like ``right_at``.
    A null group or time matches nothing; left rows without a match stay, with nulls.
    """
    right_at = right_at or at
    keyed = right.where(F.col(right_at).isNotNull()).dropna(subset=list(by))
    if order:
        keyed = last_per_key(keyed, [*by, right_at], order).drop(*order)
    values = [c for c in keyed.columns if c not in by and (c != right_at or prefix or right_at != at)]
    clash = {prefix + c for c in values} & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}; name a prefix")
    key = [F.col(b).alias(f"_by_{i}") for i, b in enumerate(by)]
    groups = [f"_by_{i}" for i in range(len(by))]
    kind = left.schema[at].dataType
    taken = F.struct(*(F.col(f"`{c}`").alias(prefix + c) for c in values), F.col(right_at).alias("_time"))
    right_rows = keyed.select(*key, F.col(right_at).cast(kind).alias("_at"), F.lit(1 if strict else 0).alias(SIDE), taken.alias(FOUND))
    row = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    left_rows = left.select(*key, F.col(at).alias("_at"), F.lit(0 if strict else 1).alias(SIDE), row.alias(ROW))
    both = right_rows.unionByName(left_rows, allowMissingColumns=True)
    carried = slices.running(both, groups, ["_at", SIDE], {"_last": slices.last_known(F.col(FOUND))})
    matched = carried.where(F.col(ROW).isNotNull())
    last = F.col("_last")
    if within is not None:
        last = F.when(F.col("_at") <= F.col("_last._time") + within, last)
    return matched.select(f"{ROW}.*", last.alias("_last")).select(
        *(F.col(f"`{c}`") for c in left.columns), *(F.col("_last")[prefix + c].alias(prefix + c) for c in values)
    )
