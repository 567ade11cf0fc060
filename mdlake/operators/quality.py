"""Completeness, profiles, type inference, drift and repair."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import numbers
from ..session import local_frame

# Columns typed by name, and the text widths of the inferred types.
DECIMAL_NAMES = ("ggt_ss", "ggt_sz", "hgt", "sgt", "north_money", "south_money")
CODE_NAMES = ("ts_code", "symbol", "exchange", "market", "content_type")
TIME_NAMES = ("time", "trade_time")
SHORT_TEXT, MEDIUM_TEXT = 64, 255


def page_completeness(rows: DataFrame, unit: list[str], page: str, page_rows: int) -> DataFrame:
    """Per work unit: pages, rows, gaps and whether the page sequence can be trusted.

    Rows are counted per page first, so a unit of any size reaches the second grouping as pages.
    A last page that is exactly full may hide a missing one.
    """
    pages = rows.groupBy(*unit, page).agg(F.count(F.lit(1)).alias("n"))
    last = F.max_by("n", page)
    return (
        pages.groupBy(*unit)
        .agg(
            F.count(F.lit(1)).alias("n_pages"),
            F.sum("n").cast("bigint").alias("n_rows"),
            (F.max(page) + 1 - F.count(F.lit(1))).cast("bigint").alias("missing_pages"),
            F.count_if(F.col("n") < page_rows).alias("short_pages"),
            F.count_if(F.col("n") > page_rows).alias("overfull_pages"),
            last.alias("last_rows"),
        )
        .withColumn("possibly_truncated", F.col("last_rows") == page_rows)
        .withColumn(
            "complete",
            (F.col("missing_pages") == 0)
            & (F.col("overfull_pages") == 0)
            & (F.col("short_pages") == 1)
            & (F.col("last_rows") < page_rows),
        )
    )


def day_completeness(bars: DataFrame, day: Column, code: str, expected: Column) -> DataFrame:
    """Distinct codes per day against the expected number."""
    return (
        bars.groupBy(day.alias("day"))
        .agg(F.count_distinct(code).alias("n_codes"))
        .withColumn("expected", expected)
        .withColumn("complete", F.col("n_codes") >= F.col("expected"))
    )


def availability(bars: DataFrame, day: Column, code: str) -> DataFrame:
    """First and last day with data, and number of bars, per code."""
    return bars.groupBy(code).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n_bars")
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: longest text, NULLs, rows. One scan, one aggregate."""
    names = df.columns
    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.max(F.length(F.col(f"`{c}`").cast("string"))).cast("bigint").alias(f"len_{i}") for i, c in enumerate(names)],
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(names)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(F.col(f"len_{i}"), F.lit(0)).alias("max_length"),
            F.col(f"null_{i}").alias("n_null"),
            F.col("n_rows").alias("n_rows"),
        )
        for i, c in enumerate(names)
    ]
    return stats.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _type_by_name_or_dtype(field: T.StructField) -> tuple[int, str] | None:
    name = field.name.lower()
    if name in DECIMAL_NAMES:
        return 1, "DECIMAL(24,2)"
    if name in CODE_NAMES:
        return 2, "VARCHAR(32)"
    if name.endswith("_date"):
        return 3, "DATE"
    if name in TIME_NAMES:
        return 4, "DATETIME"
    if isinstance(field.dataType, T.IntegralType):
        return 5, "BIGINT"
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return 6, "FLOAT"
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return 7, "DATETIME"
    return None


def infer_types(df: DataFrame) -> DataFrame:
    """Inferred storage type of each column: by name, then by data type, then by text width."""
    known = {f.name: _type_by_name_or_dtype(f) for f in df.schema}
    profile = column_profile(df)
    width = F.col("max_length")
    by_width = F.when(width <= SHORT_TEXT, f"VARCHAR({SHORT_TEXT})").when(
        width <= MEDIUM_TEXT, f"VARCHAR({MEDIUM_TEXT})"
    ).otherwise("TEXT")
    rule, inferred = F.lit(8), by_width
    for name, found in known.items():
        if found:
            rule = F.when(F.col("column_name") == name, found[0]).otherwise(rule)
            inferred = F.when(F.col("column_name") == name, found[1]).otherwise(inferred)
    return profile.select("column_name", rule.alias("rule"), inferred.alias("inferred_type"), "max_length")


def column_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column, from the schemas alone."""
    first = next(iter(tables.values()))
    rows = [
        (table, position, field.name, field.dataType.simpleString(), field.nullable)
        for table, df in tables.items()
        for position, field in enumerate(df.schema, start=1)
    ]
    ddl = "table_name string, position int, column_name string, data_type string, nullable boolean"
    return local_frame(first.sparkSession, rows, ddl)


def schema_drift(shards: Mapping[str, DataFrame], numeric: Sequence[str]) -> DataFrame:
    """Columns whose presence or type differs between shards, or that should be numeric but are text."""
    columns = column_catalog(shards)
    is_text = (F.col("data_type") == "string") & F.col("column_name").isin(*numeric)
    return (
        columns.groupBy("column_name")
        .agg(
            F.concat_ws(",", F.array_sort(F.collect_set("data_type"))).alias("types"),
            F.count_distinct("data_type").alias("n_types"),
            F.concat_ws(",", F.array_sort(F.collect_set(F.when(is_text, F.col("table_name"))))).alias("text_shards"),
            (F.lit(len(shards)) - F.count(F.lit(1))).cast("bigint").alias("missing_shards"),
        )
        .where((F.col("n_types") > 1) | (F.col("missing_shards") > 0) | (F.col("text_shards") != ""))
    )


def convertibility(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: values failing the character test and values failing the cast, in one scan."""
    counts = df.agg(
        *[F.count_if(numbers.has_non_numeric(F.col(c))).alias(f"chars_{i}") for i, c in enumerate(columns)],
        *[F.count_if(numbers.fails_cast(F.col(c))).alias(f"cast_{i}") for i, c in enumerate(columns)],
        *[F.count(F.col(c)).alias(f"filled_{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"filled_{i}").alias("n_values"),
            F.col(f"chars_{i}").alias("bad_characters"),
            F.col(f"cast_{i}").alias("bad_casts"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def repair_types(df: DataFrame, columns: Sequence[str], target: str = "decimal(24,2)") -> DataFrame:
    """Retype text columns; a value either test rejects becomes NULL."""
    casts = {}
    for c in columns:
        text = F.col(c)
        good = ~numbers.has_non_numeric(text) & ~numbers.fails_cast(text)
        casts[c] = F.when(good, F.trim(text)).try_cast(target)
    return df.withColumns(casts)


def run_report(changes: DataFrame, by: list[str]) -> DataFrame:
    """Inserted, updated and unchanged keys per group of a change summary."""
    counts = {kind: F.count_if(F.col("change") == kind) for kind in ("inserted", "updated", "unchanged")}
    return changes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_fetched"),
        *[c.alias(f"rows_{k}") for k, c in counts.items()],
        # one per insert, two per replaced row, none for identical rows: the count a server reports
        (counts["inserted"] + counts["updated"] * 2).alias("rows_affected"),
    )
