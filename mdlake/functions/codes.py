"""Instrument codes, shard routing and the within-day progress marker."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .dates import parse_date_any

# Exchange suffixes and shard labels, in hash order.
CODE_SUFFIX = r"\.(SH|SZ|BJ)\z"
SHARDS = ("P1", "P2", "P3")


def is_code(text: Column) -> Column:
    """True when the text ends in a known exchange suffix, ignoring case and outer spaces."""
    return F.coalesce(F.upper(F.trim(text)).rlike(CODE_SUFFIX), F.lit(False))


def shard_number(code: Column) -> Column:
    """First eight hex digits of the md5 of the code, modulo the number of shards."""
    head = F.conv(F.substring(F.md5(code.cast("binary")), 1, 8), 16, 10)
    return (head.cast("bigint") % len(SHARDS)).cast("int")


def shard_label(code: Column) -> Column:
    number = shard_number(code)
    label = F.when(number == 0, SHARDS[0])
    for i, name in enumerate(SHARDS[1:], start=1):
        label = label.when(number == i, name)
    return label


def progress_marker(day: Column, position: Column) -> Column:
    """``YYYY-MM-DD@n``: the next code position of an unfinished day."""
    return F.concat(day.cast("string"), F.lit("@"), position.cast("string"))


def progress_day(marker: Column) -> Column:
    """Day of a marker, NULL when either half is malformed."""
    return F.when(_position(marker).isNotNull(), parse_date_any(F.split_part(marker, F.lit("@"), F.lit(1))))


def progress_position(marker: Column) -> Column:
    """Position of a marker, never negative; 0 when either half is malformed."""
    good = progress_day(marker).isNotNull()
    return F.when(good, F.greatest(_position(marker), F.lit(0))).otherwise(F.lit(0))


def _position(marker: Column) -> Column:
    tail = F.when(F.contains(marker, F.lit("@")), F.regexp_extract(marker, r"^[^@]*@(.*)$", 1))
    return tail.try_cast("int")
