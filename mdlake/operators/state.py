"""Cursors, start dates and resumable work units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from ..functions.dates import parse_date_any
from ..plans.specs import STATE_KEYS
from .merge import upsert

# Fixed value: calendar days read on a first run of a table without retention (20 years).
FIRST_RUN_DAYS = 365 * 20


def cursor_text(value: Column) -> Column:
    """Stored cursor: trimmed, empty means none."""
    trimmed = F.trim(value)
    return F.when(trimmed != "", trimmed)


def cursor_date(value: Column) -> Column:
    return parse_date_any(cursor_text(value))


def plan_start(
    requested: Column, cursor: Column, cutoff: Column, end: Column, lookback_days: Column | int = 0
) -> Column:
    """First day to read.

    The requested start, else the day after the cursor, else the retention cutoff, else twenty years
    back; never before the cutoff. A look-back of N re-reads 2N calendar days, again not before the
    cutoff.
    """
    lookback = lookback_days if isinstance(lookback_days, Column) else F.lit(lookback_days)
    start = F.coalesce(requested, F.date_add(cursor, 1), cutoff, F.date_sub(end, FIRST_RUN_DAYS))
    clamped = F.greatest(start, cutoff)
    widened = F.when(lookback > 0, F.least(clamped, F.date_sub(end, lookback * 2))).otherwise(clamped)
    return F.greatest(widened, cutoff)


def advance_cursor(current: Column, newest: Column, rows: Column, end: Column) -> Column:
    """Next cursor: newest date with data, else ``end`` if rows were written, else unchanged; never back."""
    return F.greatest(F.coalesce(newest, F.when(rows > 0, end), current), current)


def state_upsert(state: DataFrame, changes: DataFrame, order: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """Store cursor changes; ``changes`` carries the state columns plus the ordering columns."""
    extra = [c for c in order if c not in state.columns]
    keyed = changes.withColumns({f"_o_{c}": F.col(c) for c in order}).drop(*extra)
    return upsert(state, keyed, STATE_KEYS, [f"_o_{c}" for c in order])


def pending_units(units: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work units not recorded as done."""
    return units.join(done.select(*keys).distinct(), keys, "left_anti")


def resume_point(state: DataFrame) -> DataFrame:
    """Day and position of the within-day progress marker."""
    return state.withColumn("resume_day", codes.progress_day(F.col("cursor_value"))).withColumn(
        "resume_pos", codes.progress_position(F.col("cursor_value"))
    )


def fast_forward(current: Column, newest_complete: Column, cutoff: Column, end: Column) -> Column:
    """Cursor moved up to the newest complete day, if that lies inside [cutoff, end] and ahead of it."""
    inside = newest_complete.between(cutoff, end)
    ahead = current.isNull() | (newest_complete > current)
    return F.when(inside & ahead, newest_complete).otherwise(current)
