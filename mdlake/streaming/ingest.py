"""Structured Streaming form: landed files are picked up as they arrive and merged by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.specs import TableSpec
from ..plans.update import write_batch
from ..session import staged
from ..sources.lake import LakeTable


def landed_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New files under a landing folder, as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest(
    stream: DataFrame,
    table: LakeTable,
    spec: TableSpec,
    checkpoint: str,
    order: str,
    post: Callable[[DataFrame], DataFrame] = lambda df: df,
    mode: str = "upsert",
    done_day: Callable[[], date] | None = None,
    day: Column | None = None,
    held: LakeTable | None = None,
) -> StreamingQuery:
    """Merge every micro-batch into the table; runs until the landed files are consumed.

    A batch delivered twice changes nothing, because rows are merged by key in landing order. Late and
    revised rows are merged like any others. With ``done_day`` rows of unfinished sessions are put into
    ``held`` and offered again with the next batch. Sessions finished since the last run are released before
    the stream starts, as without new files it runs no batch. A held table made by ``held_table`` keeps days
    apart, so a micro-batch rewrites only the days it has rows of.
    """
    if held is not None and done_day is not None:
        release_held(table, spec, held, done_day(), day, mode)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = post(batch).withColumnRenamed(order, "landing_order")
        # micro-batches run without adaptive execution; the merge goes on in the table's own session
        with staged(rows, f"{spec.name}-{batch_id}", table.spark) as fixed:
            if done_day is None:
                write_batch(table, spec, fixed, mode)
            elif held is None:
                write_batch(table, spec, fixed.where(day <= F.lit(done_day())), mode)
            else:
                merge_or_hold(table, spec, held, fixed, done_day(), day, mode)

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


HELD_DAY = "held_day"


def held_table(spark: SparkSession, path: str, schema: T.StructType | str) -> LakeTable:
    """A table for held rows, one partition a day."""
    return LakeTable(spark, path, schema, (HELD_DAY,))


def merge_or_hold(
    table: LakeTable, spec: TableSpec, held: LakeTable, rows: DataFrame, limit: date, day: Column, mode: str = "upsert"
) -> int:
    """Merge rows of days up to ``limit``, held ones included, and hold the others; returns the number merged."""
    at = held.snapshot()
    due = [p.part for p in at.parts if not held.partition_by or p.part.split("=")[1] <= limit.isoformat()]
    finished = day <= F.lit(limit)
    old = held.read(due, at).drop(*held.partition_by)
    merged = write_batch(table, spec, rows.where(finished).unionByName(old.where(finished), allowMissingColumns=True), mode)
    waiting = rows.where(~finished)
    if held.partition_by:
        waiting = waiting.withColumn(HELD_DAY, day.cast("string"))
    fresh = [r.part for r in waiting.select(held.part_column().alias("part")).distinct().collect()]  # bounded by the calendar
    touched = sorted({*due, *fresh})
    if touched:
        held.replace(waiting.unionByName(held.read(touched, at).where(~finished), allowMissingColumns=True), touched, at)
    return merged.fetched


def release_held(table: LakeTable, spec: TableSpec, held: LakeTable, limit: date, day: Column, mode: str = "upsert") -> int:
    """Merge held rows of days up to ``limit`` into the table; returns their number."""
    at = held.snapshot()
    due = [p.part for p in at.parts if not held.partition_by or p.part.split("=")[1] <= limit.isoformat()]
    if not due:
        return 0
    with staged(held.read(due, at).drop(*held.partition_by), f"{spec.name}-held", table.spark) as rows:
        merged = write_batch(table, spec, rows.where(day <= F.lit(limit)), mode)
    if held.partition_by:
        held.drop(due, at)
    elif merged.fetched:
        held.replace(held.read(due, at).where(day > F.lit(limit)), due, at)
    return merged.fetched


def distinct_stream(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First delivery of each key, for feeds that only ever insert.

    State is kept for ``delay`` after a key's event time. Use it where deliveries repeat within that
    delay; the merging sink above has no such limit.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
