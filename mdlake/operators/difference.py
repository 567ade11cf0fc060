"""Rows of two tables as multisets: EXCEPT ALL, INTERSECT ALL, and what was inserted, deleted or changed.

Rows are dealt to buckets by a hash. A bucket's digest is the number of its rows and two sums of independent
64-bit row hashes, which, unlike exclusive-or, keep repeated rows apart. Buckets with equal digests hold equal
rows, but for a clash of 128 bits, and only the others are compared row by row. Digests are small tables that
may be stored beside a table, so that comparing it again reads only what differs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .cleaning import to_schema

BUCKETS = 1024
BUCKET, COPIES = "_bucket", "_copies"
DIGEST = ["_n", "_a", "_b"]


def row_hash(columns: Sequence[str], half: int) -> Column:
    """64-bit hash of a row. Nulls are told apart by flags, as the hash alone passes over them."""
    parts = [p for c in columns for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(half), *parts)


def bucket_of(columns: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(row_hash(columns, 0), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, _n, _a, _b) of a table, at most one row per bucket; rows are dealt by ``keys`` or as a whole."""
    columns = sorted(df.columns)
    sums = [F.sum(row_hash(columns, half).cast("decimal(38,0)")).alias(name) for half, name in ((1, "_a"), (2, "_b"))]
    return df.groupBy(bucket_of(keys or columns, buckets).alias(BUCKET)).agg(F.count(F.lit(1)).alias("_n"), *sums)


def differing_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """Buckets whose digests differ, from two frames of ``bucket_digests``."""
    same = reduce(lambda a, b: a & b, (F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in DIGEST))
    both = old.alias("o").join(new.alias("n"), F.col(f"o.{BUCKET}") == F.col(f"n.{BUCKET}"), "full")
    return both.where(~same).select(F.coalesce(f"o.{BUCKET}", f"n.{BUCKET}").alias(BUCKET))


def _in_buckets(df: DataFrame, wanted: DataFrame, keys: Sequence[str] | None, buckets: int, how: str) -> DataFrame:
    dealt = df.withColumn(BUCKET, bucket_of(keys or sorted(df.columns), buckets))
    return dealt.join(F.broadcast(wanted), BUCKET, how).drop(BUCKET)  # one row per bucket


def _counted(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with the number of their copies on each side: _old, _new. Copies are summed before the shuffle."""
    sides = old.select(*columns, F.lit(1).alias("_o"), F.lit(0).alias("_w")).unionByName(
        new.select(*columns, F.lit(0).alias("_o"), F.lit(1).alias("_w"))
    )
    return sides.groupBy(*columns).agg(F.sum("_o").alias("_old"), F.sum("_w").alias("_new"))


def _repeated(df: DataFrame, copies: Column, columns: Sequence[str]) -> DataFrame:
    numbered = df.withColumn(COPIES, copies).where(F.col(COPIES) > 0)
    return numbered.withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES)))).select(*columns)


def _checked(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    return old, to_schema(new.select(*old.columns), old.schema)


def row_changes(old: DataFrame, new: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Distinct rows that one side has more often, with ``change`` (inserted or deleted) and ``n_rows``."""
    old, new = _checked(old, new)
    wanted = differing_buckets(bucket_digests(old, None, buckets), bucket_digests(new, None, buckets))
    sides = (_in_buckets(f, wanted, None, buckets, "left_semi") for f in (old, new))
    difference = F.col("_new") - F.col("_old")
    return _counted(*sides, old.columns).where(difference != 0).select(
        *old.columns, F.when(difference > 0, "inserted").otherwise("deleted").alias("change"), F.abs(difference).alias("n_rows")
    )


def except_all(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows of ``left`` without, for each row of ``right``, one equal row. Nulls are equal."""
    deleted = row_changes(left, right, buckets).where("change = 'deleted'")
    return _repeated(deleted, F.col("n_rows"), left.columns)


def intersect_all(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows that both sides have, as often as the side that has fewer. Nulls are equal."""
    left, right = _checked(left, right)
    wanted = differing_buckets(bucket_digests(left, None, buckets), bucket_digests(right, None, buckets))
    sides = (_in_buckets(f, wanted, None, buckets, "left_semi") for f in (left, right))
    shared = _repeated(_counted(*sides, left.columns), F.least("_old", "_new"), left.columns)
    return _in_buckets(left, wanted, None, buckets, "left_anti").unionByName(shared)


def keyed_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(keys, change, old, new): keys inserted, deleted or changed, with both rows' other columns as structs.

    Keys must be unique on each side; null key parts match each other.
    """
    old, new = _checked(old, new)
    wanted = differing_buckets(bucket_digests(old, keys, buckets), bucket_digests(new, keys, buckets))
    values = [c for c in old.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = _in_buckets(df, wanted, keys, buckets, "left_semi")
        key = [F.struct(F.col(k).isNull().alias("none"), F.col(k).alias("key")).alias(f"_{k}") for k in keys]  # never null, so a plain equi-join
        return rows.select(*key, F.struct(*values).alias(name))

    both = side(old, "old").join(side(new, "new"), [f"_{k}" for k in keys], "full").where(~F.col("old").eqNullSafe(F.col("new")))
    change = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "deleted").otherwise("changed")
    return both.select(*(F.col(f"_{k}")["key"].alias(k) for k in keys), change.alias("change"), "old", "new")
