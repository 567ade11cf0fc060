"""Cleaning of landed columns (the post step of every table)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import codes, dates, numbers
from ..plans.specs import TableSpec


def raw_text(df: DataFrame, name: str) -> Column:
    """A landed column as vendor text; whole floats lose their fraction, others become NULL."""
    dtype = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        whole = column.try_cast("bigint")
        return F.when(column == whole, whole.cast("string"))
    return column.cast("string")


def as_number(df: DataFrame, name: str) -> Column:
    """A landed column as DOUBLE, whatever type it arrived in."""
    dtype = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(dtype, T.NumericType):
        return numbers.null_if_not_finite(column.cast("double"))
    return numbers.to_number(column.cast("string"))


def normalize_dates(df: DataFrame, names: Iterable[str], wide_dates: bool = False) -> DataFrame:
    """Parse compact date columns; absent columns and real dates are left alone."""
    todo = [n for n in names if n in df.columns and not isinstance(df.schema[n].dataType, T.DateType)]
    return df.withColumns({n: dates.parse_compact_date(raw_text(df, n), wide_dates) for n in todo})


def normalize_timestamps(df: DataFrame, name: str, batch: str | None = None) -> DataFrame:
    """Parse 14-digit times.

    With ``batch`` (for bars: the source file) a batch in which no row parses strictly is read with the
    generic formats instead. Batches and rows meet in a left join, which adaptive execution broadcasts if the
    failed batches are few and splits if one of them is large.
    """
    if name not in df.columns or isinstance(df.schema[name].dataType, (T.TimestampNTZType, T.TimestampType)):
        return df
    text = raw_text(df, name)
    strict = dates.parse_compact_timestamp(text)
    if batch is None:
        return df.withColumn(name, strict)
    failed = (
        df.groupBy(F.col(batch).alias("_failed_batch"))
        .agg(F.bool_or(strict.isNotNull()).alias("_any"))
        .where(~F.col("_any"))
        .select("_failed_batch")
    )
    parsed = F.when(F.col("_failed_batch").isNull(), strict).otherwise(dates.parse_generic_timestamp(text))
    return (
        df.join(failed, F.col(batch) == F.col("_failed_batch"), "left")
        .withColumn(name, parsed)
        .drop("_failed_batch")
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN of every floating column into NULL."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({n: F.nanvl(F.col(n), F.lit(None)) for n in floating})


def lots_to_shares(df: DataFrame, source: str) -> DataFrame:
    """Volume in lots becomes ``vol_share`` in shares."""
    if source not in df.columns:
        return df
    return df.withColumn("vol_share", as_number(df, source) * numbers.SHARES_PER_LOT).drop(source)


def thousands_to_units(df: DataFrame, name: str) -> DataFrame:
    """Turnover in thousand yuan becomes yuan."""
    if name not in df.columns:
        return df
    return df.withColumn(name, as_number(df, name) * numbers.YUAN_PER_THOUSAND)


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast known columns to their target types without failing; extra columns pass through."""
    casts = {}
    for field in schema:
        if field.name not in df.columns or df.schema[field.name].dataType == field.dataType:
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            casts[field.name] = as_number(df, field.name)
        elif isinstance(field.dataType, T.LongType):
            # whole numbers keep every digit, other notations go through a double
            whole = F.trim(column.cast("string")).try_cast("bigint") if isinstance(df.schema[field.name].dataType, T.StringType) else F.lit(None)
            casts[field.name] = F.coalesce(whole, as_number(df, field.name).try_cast("bigint"))
        elif isinstance(field.dataType, T.DecimalType):
            target = field.dataType
            casts[field.name] = numbers.to_decimal(column.cast("string"), target.precision, target.scale)
        else:
            casts[field.name] = column.try_cast(field.dataType.simpleString())
    return df.withColumns(casts) if casts else df


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply every column rule of a table specification."""
    df = normalize_dates(df, spec.dates)
    if spec.open_flag and spec.open_flag in df.columns:
        df = df.withColumn(spec.open_flag, numbers.open_flag(F.col(spec.open_flag).cast("string")))
    if spec.thousands_to_units:
        df = thousands_to_units(df, spec.thousands_to_units)
    if spec.lots_to_shares:
        df = lots_to_shares(df, spec.lots_to_shares)
    return nan_to_null(to_schema(df, spec.schema))


def clean_bars(df: DataFrame, spec: TableSpec, batch: str | None = None) -> DataFrame:
    """Bars: parse times, convert volume, keep turnover unscaled."""
    return clean(normalize_timestamps(df, "trade_time", batch), spec)


def drop_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows whose key has a missing part can never be addressed again; remove all of them."""
    return df.dropna(how="any", subset=list(keys))


def only_codes(df: DataFrame, wanted: DataFrame, code: str = "ts_code") -> DataFrame:
    """Restrict any table to a list of codes (left semi join; the optimizer sizes the list)."""
    return df.join(wanted.select(code).distinct(), code, "left_semi")


def universe(instruments: DataFrame, code: str = "ts_code") -> DataFrame:
    """Distinct trimmed non-empty codes."""
    trimmed = F.trim(F.col(code))
    return instruments.where(F.col(code).isNotNull()).select(trimmed.alias(code)).where(F.col(code) != "").distinct()


def with_shard(df: DataFrame, code: str = "ts_code") -> DataFrame:
    return df.withColumn("shard", codes.shard_label(F.col(code)))
