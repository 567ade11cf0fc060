"""Vendor dates and times.

Parsing builds an ISO text and uses ``try_cast``: bad text gives NULL under ANSI mode and no
session time zone is involved, because the results are DATE and TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Vendor dates and times outside the range of nanosecond timestamps count as missing
# (1677-09-22 to 2262-04-11, and 1677-09-21 00:12:44 to 2262-04-11 23:47:16). The limits are part of
# the patterns, so that a parsed value is one expression and is not evaluated again to be compared.
_INNER_YEARS = r"167[89]|16[89]\d|1[7-9]\d\d|2[01]\d\d|22[0-5]\d|226[01]"
_DATE_RANGE = rf"(?=167709(?:2[2-9]|30)|16771[0-2]|2262(?:0[1-3]|040\d|041[01]|04 [1-9])|{_INNER_YEARS})"
_TIME_RANGE = (
    r"(?=16770921(?!00(?:0\d|1[01]|12[0-3]\d|124[0-3]))|167709(?:2[2-9]|30)|16771[0-2]"
    rf"|22620411(?!23(?:47(?:1[7-9]|[2-5]\d)|4[89]|5\d))|2262(?:0[1-3]|040\d|0410)|{_INNER_YEARS})"
)
MIN_TIME, MAX_TIME = "1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775"

# Trading session bounds.
SESSION_OPEN, SESSION_CLOSE = "09:30:00", "15:00:00"


# One pass turns the vendor form into ISO text and everything else into text no cast accepts. Shorter
# digit strings need no zero padding: padded, they name years before the accepted range.
_DATE_PARTS = r"(\d{4})(\d\d)(?:(\d\d)| ([1-9]))(?:\.0)?"
_TIME_PARTS = r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)"


def parse_compact_date(text: Column, wide_dates: bool = False) -> Column:
    """``yyyymmdd`` text (optionally ending in ``.0``) to DATE, NULL when invalid.

    Dates outside the nanosecond range are missing unless ``wide_dates`` is set.
    """
    accepted = "" if wide_dates else _DATE_RANGE
    return F.regexp_replace(text, rf"(?s)^(?:{accepted}{_DATE_PARTS}|.*)\z", "$1-$2-$3$4").try_cast("date")


def parse_compact_timestamp(text: Column) -> Column:
    """``yyyymmddHHMMSS`` text (fraction and spaces ignored) to TIMESTAMP_NTZ, NULL when invalid."""
    digits = F.regexp_replace(text, r"\.\d+$|\s+", "")
    iso = F.regexp_replace(digits, rf"(?s)^(?:{_TIME_RANGE}{_TIME_PARTS}|.*)\z", "$1-$2-$3 $4:$5:$6")
    return iso.try_cast("timestamp_ntz")


def _in_time_range(stamp: Column) -> Column:
    low, high = (F.lit(v).cast("timestamp_ntz") for v in (MIN_TIME, MAX_TIME))
    return F.when(stamp.between(low, high), stamp)


def parse_generic_timestamp(text: Column) -> Column:
    """Fallback formats: ISO, slashed dates, ``yyyymmddHHMM`` and ``yyyymmdd``."""
    trimmed = F.trim(text)
    slashed = F.regexp_replace(trimmed, r"^(\d{4})/(\d\d)/(\d\d)", "$1-$2-$3")
    minutes = F.regexp_replace(slashed, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:00")
    days = F.regexp_replace(minutes, r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3")
    return _in_time_range(days.try_cast("timestamp_ntz"))


def parse_date_any(text: Column) -> Column:
    """``YYYY-MM-DD`` or ``YYYYMMDD`` to DATE, NULL when invalid."""
    trimmed = F.trim(text)
    dashed = F.when(trimmed.rlike(r"^\d{4}-\d\d-\d\d\z"), trimmed)
    compact = F.when(
        trimmed.rlike(r"^\d{8}\z"),
        F.regexp_replace(trimmed, r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3"),
    )
    return F.when(F.contains(trimmed, F.lit("-")), dashed).otherwise(compact).try_cast("date")


def compact_date(day: Column) -> Column:
    """DATE (or the day of a timestamp) to ``yyyymmdd`` text."""
    return F.translate(day.cast("date").cast("string"), "-", "")


def compact_timestamp(stamp: Column) -> Column:
    """Timestamp to 14-digit text."""
    return F.date_format(stamp, "yyyyMMddHHmmss")


def session_bound(day: Column, clock: str) -> Column:
    """TIMESTAMP_NTZ of a day at a fixed clock time."""
    return F.concat(day.cast("string"), F.lit(" " + clock)).try_cast("timestamp_ntz")


def in_session(stamp: Column) -> Column:
    """True for bars between the session bounds of their own day, both included."""
    day = stamp.cast("date")
    return stamp.between(session_bound(day, SESSION_OPEN), session_bound(day, SESSION_CLOSE))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column) -> Column:
    """``yyyy-MM`` text, the partition value of date-keyed tables."""
    return F.substring(day.cast("string"), 1, 7)
