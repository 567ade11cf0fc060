"""Keyed merging: in-batch duplicates, feed merge, upsert, insert-ignore and schema evolution.

Physical shape. Keeping one row per key is ``row_number() = 1``; Spark limits each group before the
shuffle (WindowGroupLimit), so a key that owns a third of the rows ships one row per task. The target
is never grouped: it meets only the batch's distinct keys, in semi and anti joins that the optimizer
broadcasts when the keys are few and runs as skew-aware sort-merge joins when they are not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T


def _first_by(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of every key in landing order (what a sequence of replacing inserts leaves).

    Without ordering columns the rows are taken to be unique already.
    """
    if not order:
        return df
    return _first_by(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of every key in landing order (what a sequence of ignoring inserts leaves).

    Without ordering columns the rows are taken to be unique already.
    """
    if not order:
        return df
    return _first_by(df, keys, [F.col(c).asc_nulls_last() for c in order])


def union_by_name(frames: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Concatenate frames by column name, missing columns NULL.

    A column that is text in one frame and a number in another would fail while running, so each
    frame is first cast to the target schema when one is given.
    """
    from .cleaning import to_schema

    aligned = [to_schema(f, schema) for f in frames] if schema else list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def merge_feeds(
    main: DataFrame,
    extra: DataFrame,
    keys: Sequence[str],
    day: str,
    order: Sequence[str] = (),
    null_safe: bool = True,
) -> DataFrame:
    """Full outer merge of two daily feeds.

    Columns both feeds carry are the main feed's; keys only the extra feed has get NULL there. On a
    day without any main rows the extra feed passes unchanged, its own values included. ``order``
    names landing-order columns that make each feed unique per key first; without it the feeds must
    already be unique. ``null_safe`` lets missing key parts match each other.
    """
    every = main
    if order:
        main, extra = (last_per_key(f, keys, order).drop(*order) for f in (main, extra))
    shared = [c for c in extra.columns if c in main.columns and c not in keys]
    # a day of the key has main rows whichever of them are kept
    main_days = (every if day in keys else main).select(F.col(day).alias("_day")).distinct().withColumn("_main_day", F.lit(True))
    if isinstance(main.schema[day].dataType, T.DateType):
        main_days = F.broadcast(main_days)  # one row per parsed date, about 213,000 dates exist

    left = main.withColumn("_has_main", F.lit(True)).alias("m")
    right = extra.alias("x")
    same = (lambda k: F.col(f"m.{k}").eqNullSafe(F.col(f"x.{k}"))) if null_safe else (
        lambda k: F.col(f"m.{k}") == F.col(f"x.{k}")
    )
    matched = left.join(right, reduce(lambda a, b: a & b, [same(k) for k in keys]), "full")
    has_main = F.col("m._has_main").isNotNull()
    key_columns = [F.when(has_main, F.col(f"m.{k}")).otherwise(F.col(f"x.{k}")).alias(k) for k in keys]
    own = [F.col(f"m.`{c}`") for c in main.columns if c not in keys and c not in shared]
    both = [F.struct(F.col(f"m.`{c}`").alias("m"), F.col(f"x.`{c}`").alias("x")).alias(c) for c in shared]
    added = [F.col(f"x.`{c}`") for c in extra.columns if c not in keys and c not in shared]
    flagged = matched.select(*key_columns, *own, *both, *added, has_main.alias("_has_main")).join(
        main_days, F.col(day).eqNullSafe(F.col("_day")), "left"
    )
    pass_extra = ~F.col("_has_main") & F.col("_main_day").isNull()
    picked = {c: F.when(pass_extra, F.col(c)["x"]).otherwise(F.col(c)["m"]) for c in shared}
    columns = list(main.columns) + [c for c in extra.columns if c not in main.columns]
    return flagged.withColumns(picked).select(*[F.col(f"`{c}`") for c in columns])


def evolve_schema(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add the batch's new columns to the target as NULL; returns the target and the added names.

    A batch without a key column is an error; existing columns are never dropped or retyped.
    """
    missing = [k for k in keys if k not in batch.columns]
    if missing:
        raise ValueError(f"key columns missing from the batch: {missing}")
    added = [f for f in batch.schema if f.name not in target.columns]
    return target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}), [f.name for f in added]


def _aligned(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    from .cleaning import to_schema

    batch = to_schema(batch, target.schema)
    target, _ = evolve_schema(target, batch.drop(*order), keys)
    return target, batch


def _met_by(target: DataFrame, batch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys and some columns of the target rows the batch refers to."""
    return target.select(*keys, *columns).join(batch.select(*keys).distinct(), list(keys), "left_semi")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep_absent: bool = False,
) -> DataFrame:
    """Insert new keys and replace existing rows as a whole.

    Columns the batch lacks become NULL on replaced rows; ``keep_absent`` keeps the target's values
    instead. ``order`` is the landing order that decides between duplicates inside the batch; its
    columns are not stored.
    """
    target, batch = _aligned(target, batch, keys, order)
    winners = last_per_key(batch, keys, order).drop(*order)
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    absent = [c for c in target.columns if c not in winners.columns]
    if keep_absent and absent:
        winners = winners.join(_met_by(target, batch, keys, absent), list(keys), "left")
    return kept.unionByName(winners, allowMissingColumns=True)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add only keys the target lacks; the first duplicate inside the batch wins."""
    target, batch = _aligned(target, batch, keys, order)
    fresh = batch.join(_met_by(target, batch, keys, []), list(keys), "left_anti")
    return target.unionByName(first_per_key(fresh, keys, order).drop(*order), allowMissingColumns=True)


def write_mode(mode: str):
    """The merge function of a write mode name."""
    return {"upsert": upsert, "ignore": insert_ignore}[mode]


def change_summary(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per batch key with ``change`` = inserted, updated or unchanged."""
    target, batch = _aligned(target, batch, keys, order)
    winners = last_per_key(batch, keys, order).drop(*order)
    values = [c for c in target.columns if c not in keys]
    absent = [c for c in values if c not in winners.columns]
    winners = winners.withColumns({c: F.lit(None).cast(target.schema[c].dataType) for c in absent})
    old = _met_by(target, batch, keys, values).select(*keys, F.struct(*values).alias("_old"))
    new = winners.select(*keys, F.struct(*values).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "inserted").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
    ).otherwise("updated")
    return new.join(old, list(keys), "left").select(*keys, change.alias("change"))
