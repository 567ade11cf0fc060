"""Intraday bars landed as gzip CSV with a header.

The files do not agree on column order, and may have any number of further columns, unnamed ones included. Lines
are read once and split into as many fields as they have; each file's first line then says which position holds
which column, and lines and headers meet in a join by file. Empty files yield no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import checkpointed
from .landed import LANDED_DAY, LANDING_ORDER, with_landing_order

# The columns of a bar file.
BAR_COLUMNS = ("ts_code", "trade_time", "open", "high", "low", "close", "volume", "amount")
KEY_COLUMNS = ("ts_code", "trade_time")
SOURCE_FILE = "source_file"
QUOTED = r',("[^"]*(?:""[^"]*)*"|[^,]*)'


def csv_fields(line: Column) -> Column:
    """The fields of a line, quotes removed; an empty field is null."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(QUOTED), F.lit(1))
    inner = F.transform(
        found, lambda f: F.when(f.startswith('"'), F.replace(F.substr(f, F.lit(2), F.char_length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f)
    )
    fields = F.when(F.contains(line, F.lit('"')), inner).otherwise(F.split(line, ",", -1))
    return F.transform(fields, lambda f: F.when(f != "", f))


def read_bars_csv(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...] = BAR_COLUMNS,
    days: Sequence[str] | None = None,
    required: tuple[str, ...] = KEY_COLUMNS,
) -> DataFrame:
    """All bars under ``path`` as text columns by header name, plus file and landing order of each row.

    ``days`` restricts the read to some day folders, an empty text standing for files outside of them. A file
    whose header lacks a column of ``required`` fails the read when its rows are wanted; other columns that a
    header lacks are null. Of columns with one name the first counts.
    """
    reader = spark.read.option("pathGlobFilter", "*.csv*")
    if days is None:
        raw = reader.option("recursiveFileLookup", "true").text(path)
    else:
        folders = [f"{path}/{LANDED_DAY}={d}" for d in days if d] + [f"{path}/*.csv*"] * ("" in days)
        raw = reader.text(folders) if folders else None
    if raw is None:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*columns, SOURCE_FILE)])
        position = "struct<file_time timestamp, file string, split bigint, row bigint>"
        return spark.createDataFrame([], schema).withColumn(LANDING_ORDER, F.lit(None).cast(position))
    # unzipped once; the header and the rows are taken from here
    lines = checkpointed(
        with_landing_order(raw.where(F.trim("value") != "").select("value", "_metadata")).select(
            F.col(f"{LANDING_ORDER}.file").alias(SOURCE_FILE), LANDING_ORDER, "value"
        )
    )
    headers = lines.groupBy(SOURCE_FILE).agg(F.min_by(F.struct("value", LANDING_ORDER), LANDING_ORDER).alias("_first")).select(
        SOURCE_FILE,
        F.transform(csv_fields(F.col("_first.value")), lambda n: F.trim(F.ltrim(n, F.lit("\ufeff")))).alias("_names"),
        F.col(f"_first.{LANDING_ORDER}").alias("_header_at"),
    )

    def position(name: str) -> Column:
        found = F.array_position("_names", name)
        if name not in required:
            return found
        fault = F.concat(F.lit(f"no column {name} in the header of "), F.col(SOURCE_FILE))
        return F.when(F.coalesce(found, F.lit(0)) > 0, found).otherwise(F.raise_error(fault).cast("long"))

    # looked up once a file, not once a row
    placed = headers.select(SOURCE_FILE, "_header_at", F.struct(*(position(n).alias(n) for n in columns)).alias("_at"))
    body = lines.join(placed, SOURCE_FILE).where(F.col(LANDING_ORDER) != F.col("_header_at")).withColumn("_fields", csv_fields(F.col("value")))

    def named(name: str) -> Column:
        at = F.col("_at")[name]
        return F.when(at > 0, F.get("_fields", (at - 1).cast("int"))).alias(name)

    return body.select(*map(named, columns), SOURCE_FILE, LANDING_ORDER)


def write_bars_csv(bars: DataFrame, path: str) -> None:
    """Land bars the way the terminal does: gzip CSV with a header."""
    bars.write.mode("append").option("header", "true").option("compression", "gzip").csv(path)
