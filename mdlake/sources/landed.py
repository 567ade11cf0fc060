"""Landed vendor extracts.

Layout: ``<root>/<feed>/landed_day=<yyyymmdd>/...`` or, without day folders, ``<root>/<feed>/...``. Columns
are read with an explicit schema; the day predicate prunes whole folders.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import checkpointed

LANDED_DAY = "landed_day"
LANDING_ORDER = "landing_order"
FILES = "path string, length bigint, modified bigint, landed_day string"


def file_name(path: Column) -> Column:
    """One spelling of a file's address, whichever reader names it."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def list_files(spark: SparkSession, path: str, start: date | None = None, end: date | None = None, names: str = "*") -> DataFrame:
    """(path, length, modified, landed_day) of the non-empty files in day folders within [start, end] and outside
    of day folders, where the day is empty. A missing folder has no files.

    The list is fixed when it is made: a file that lands or changes later is not on it, so it is not taken as read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names)
    try:
        found = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], FILES)
        raise
    day = F.regexp_extract("path", rf"/{LANDED_DAY}=(\d{{8}})/", 1)
    files = found.where(F.col("length") > 0).select(
        file_name(F.col("path")).alias("path"), "length", F.unix_micros("modificationTime").alias("modified"), day.alias(LANDED_DAY)
    )
    if start is not None:
        files = files.where((F.col(LANDED_DAY) == "") | (F.col(LANDED_DAY) >= start.strftime("%Y%m%d")))
    if end is not None:
        files = files.where((F.col(LANDED_DAY) == "") | (F.col(LANDED_DAY) <= end.strftime("%Y%m%d")))
    return checkpointed(files)


def with_landing_order(df: DataFrame) -> DataFrame:
    """Add a sortable position: file time, file, split, then row order inside the split.

    The running id only ever decides between rows of one split, which one task reads in file order.
    """
    position = F.struct(
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", position.alias(LANDING_ORDER))


def _text_lines(spark: SparkSession, path: str, start: date | None, end: date | None) -> DataFrame:
    """(value, _metadata) of text files, skipping day folders outside [start, end]."""
    lines = spark.read.text(path)
    day = F.col(LANDED_DAY).cast("string") if LANDED_DAY in lines.columns else F.lit(None).cast("string")
    if start is not None:
        lines = lines.where(day.isNull() | (day >= start.strftime("%Y%m%d")))
    if end is not None:
        lines = lines.where(day.isNull() | (day <= end.strftime("%Y%m%d")))
    return lines.where(F.trim("value") != "")


def json_columns(spark: SparkSession, path: str, start: date | None = None, end: date | None = None) -> T.StructType:
    """Columns of landed JSON objects, one per line, with the types that fit all lines.

    Types are merged by an aggregate over all lines, so files need not agree. Whole numbers are bigint, others
    double; a column that is a number here and text there, or that is nested, is text. Lines that are no object
    do not count.
    """
    parsed = F.try_parse_json("value")
    lines = _text_lines(spark, path, start, end).where(F.schema_of_variant(parsed).startswith("OBJECT"))
    merged = lines.agg(F.schema_of_variant_agg(parsed)).first()[0]
    if not merged.startswith("OBJECT<"):
        return T.StructType()
    found = T.StructType.fromDDL(merged.replace("OBJECT<", "STRUCT<")[len("STRUCT<") : -1])

    def simple(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.LongType):
            return kind
        return T.DoubleType() if isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)) else T.StringType()

    return T.StructType([T.StructField(f.name, simple(f.dataType)) for f in found])


def quarantined(spark: SparkSession, root: str, feed: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """(file, value) of landed lines that are no JSON object, which no reader turns into a row."""
    kind = F.schema_of_variant(F.try_parse_json("value"))
    bad = _text_lines(spark, f"{root}/{feed}", start, end).where(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)))
    return bad.select(F.col("_metadata.file_path").alias("file"), "value")


def added_columns(spark: SparkSession, root: str, feed: str, schema: T.StructType, start: date | None = None, end: date | None = None) -> T.StructType:
    """Columns of a landed JSON feed that its schema does not name; none if the feed never landed.

    Only names are read from the lines; types are merged when there is a new name.
    """
    known = {n.lower() for n in (*schema.names, LANDED_DAY)}
    path = f"{root}/{feed}"
    try:
        lines = _text_lines(spark, path, start, end)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return T.StructType()
        raise
    # lines agree in few sets of names, so they are told apart before names are compared
    sets = lines.select(F.json_object_keys("value").alias("names")).distinct()
    named = F.array(*(F.lit(n) for n in schema.names))
    others = sets.select(F.explode(F.array_except("names", named)).alias("name")).distinct()
    new = {r["name"] for r in others.collect() if r["name"].lower() not in known}
    return T.StructType([f for f in json_columns(spark, path, start, end) if f.name in new]) if new else T.StructType()


def read_landed(
    spark: SparkSession,
    root: str,
    feed: str,
    schema: T.StructType,
    fmt: str = "json",
    start: date | None = None,
    end: date | None = None,
    where: Callable[[DataFrame], DataFrame] | None = None,
    **options: str,
) -> DataFrame:
    """Rows of a feed in landing order, skipping day folders outside [start, end].

    ``where`` filters the raw rows before they are numbered, so that its conditions reach the scan.

    Text formats are read with the given schema; CSV needs a header that agrees with it, otherwise the
    read fails, because Spark would assign columns by position. Columnar formats keep the types they
    carry, columns of all files are read, and absent columns are NULL.
    """
    path = f"{root}/{feed}"
    if fmt in ("parquet", "orc"):
        options = {"mergeSchema": "true"} | options
        df = spark.read.format(fmt).options(**options).load(path)
        absent = [n for n in (*schema.names, LANDED_DAY) if n not in df.columns]
    else:
        if fmt == "csv":
            options = {"header": "true", "enforceSchema": "false"} | options
        with_day = T.StructType([*schema.fields, T.StructField(LANDED_DAY, T.StringType())])
        df = spark.read.schema(with_day).options(**options).format(fmt).load(path)
        absent = []
    day = F.lit(None).cast("string") if LANDED_DAY in absent else F.col(LANDED_DAY).cast("string")
    if start is not None:
        df = df.where(day.isNull() | (day >= start.strftime("%Y%m%d")))
    if end is not None:
        df = df.where(day.isNull() | (day <= end.strftime("%Y%m%d")))
    if where is not None:
        df = where(df)
    ordered = with_landing_order(df).drop(LANDED_DAY)
    missing = {n: F.lit(None).cast("string") for n in absent if n != LANDED_DAY}
    return ordered.withColumns(missing) if missing else ordered


def landed_or_none(*args, **kwargs) -> DataFrame | None:
    """Like :func:`read_landed`, but None when the feed never landed."""
    try:
        return read_landed(*args, **kwargs)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_codes(spark: SparkSession, path: str, code: str = "ts_code") -> DataFrame:
    """Codes file: one per line, trimmed, blanks dropped."""
    trimmed = F.trim(F.col("value"))
    return spark.read.text(path).select(trimmed.alias(code)).where(F.col(code) != "")
