"""Positions, chunks and samples of the code list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import checkpointed


def positions(df: DataFrame, by: str, order: str, output: str = "pos") -> DataFrame:
    """0-based position of each row inside its group, without putting a group into one task.

    Rows are range-partitioned by (group, order) and checkpointed, so that slices are fixed data;
    the position is the rank inside the slice plus the sizes of the group's earlier slices. Only the
    slice sizes (one row per slice and group) are summed over a group. Rows without a group are one group.
    """
    sliced = checkpointed(
        df.repartitionByRange(F.col(by), F.col(order)).withColumn("_slice", F.spark_partition_id())
    )
    sizes = sliced.groupBy(by, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.partitionBy(by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(F.col(by).alias("_by"), F.col("_slice").alias("_part"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(W.partitionBy(by, "_slice").orderBy(order)) - 1
    return (
        sliced.withColumn("_inside", inside)
        .join(offsets, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_slice") == F.col("_part")))
        .withColumn(output, (F.col("_inside") + F.col("_offset")).cast("bigint"))
        .drop("_slice", "_inside", "_offset", "_by", "_part")
    )


def chunk_codes(codes: DataFrame, size: int, code: str = "ts_code", shard: str = "shard") -> DataFrame:
    """Number each shard's sorted codes and cut them into chunks: adds pos, chunk and n_chunks."""
    numbered = positions(codes, shard, code)
    totals = numbered.groupBy(F.col(shard).alias("_shard")).agg(F.count(F.lit(1)).alias("_total"))
    return (
        numbered.join(F.broadcast(totals), F.col(shard).eqNullSafe(F.col("_shard")))  # one row per shard
        .withColumn("chunk", F.floor(F.col("pos") / size) + 1)
        .withColumn("n_chunks", F.ceil(F.col("_total") / size))
        .drop("_total", "_shard")
    )


def resume_after(chunks: DataFrame, day: str, marker_day: str, marker_pos: str) -> DataFrame:
    """Drop codes of the marked day that were finished before the interruption."""
    done = F.col(day).eqNullSafe(F.col(marker_day)) & (F.col("pos") < F.col(marker_pos))
    return chunks.where(~F.coalesce(done, F.lit(False)))


def sample_codes(codes: DataFrame, n: int, seed: int | None = None, code: str = "ts_code") -> DataFrame:
    """``n`` codes in random order, or in a repeatable hash order when no seed is given."""
    key = F.md5(F.col(code).cast("binary")) if seed is None else F.rand(seed)
    return codes.orderBy(key, code).limit(n)
