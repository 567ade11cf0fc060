"""Numbers that arrive as text, units and missing markers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: plain decimal notation with optional exponent. Java would also accept type
# suffixes (1d), hex floats, NaN and Infinity, none of which is a vendor number.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"

# The same without exponents or lengths that could overflow to infinity.
SMALL_NUMBER = r"^\s*[+-]?(\d{1,200}\.?\d*|\.\d+)([eE][+-]?\d{1,2})?\s*\z"

# Fixed value: characters that make a text column inconvertible in the audit's simple test.
NON_NUMERIC = r"[^0-9.\-]"

# Vendor units. Lots hold 100 shares; daily turnover is in thousand yuan.
SHARES_PER_LOT = 100.0
YUAN_PER_THOUSAND = 1000.0


def null_if_not_finite(value: Column) -> Column:
    """NaN and infinities are missing values."""
    return F.when(F.abs(value) < float("inf"), value)  # NaN sorts above infinity


def to_number(text: Column) -> Column:
    """Text to DOUBLE, NULL when it is not a finite plain number."""
    value = text.try_cast("double")
    # ordinary numbers are matched and cast once; only the rest is looked at again
    return F.when(text.rlike(SMALL_NUMBER), value).when(text.rlike(NUMBER), null_if_not_finite(value))


def to_decimal(text: Column, precision: int = 24, scale: int = 2) -> Column:
    """Text to DECIMAL, rounding half up, NULL when not a number or too wide."""
    return F.when(text.rlike(NUMBER), F.trim(text)).try_cast(f"decimal({precision},{scale})")


def to_whole(text: Column) -> Column:
    """Text to BIGINT through DOUBLE, so that ``1.5`` truncates instead of failing."""
    return to_number(text).try_cast("bigint")


def open_flag(text: Column) -> Column:
    """Calendar flag: numbers truncate, anything else means closed."""
    return F.coalesce(to_whole(text), F.lit(0).cast("bigint"))


def has_non_numeric(text: Column) -> Column:
    """Simple text test of the audit: any character outside digits, dot and minus."""
    return F.coalesce(text.isNotNull() & (text != "") & text.rlike(NON_NUMERIC), F.lit(False))


def fails_cast(text: Column) -> Column:
    """Strict test of the audit: non-empty text that is not a number."""
    return F.coalesce((text != "") & to_number(text).isNull(), F.lit(False))
