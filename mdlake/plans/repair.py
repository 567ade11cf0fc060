"""Audit and repair of stored tables whose numeric columns ended up as text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

from ..operators import quality
from ..sources.lake import LakeTable


@dataclass(frozen=True)
class RepairReport:
    text_columns: tuple[str, ...]
    missing_columns: tuple[str, ...]
    bad_characters: dict[str, int]
    bad_casts: dict[str, int]
    applied: bool


def repair_table(table: LakeTable, numeric: Sequence[str], target: str = "decimal(24,2)", apply: bool = False) -> RepairReport:
    """Report text columns that should be numeric and, with ``apply``, retype them as a new revision.

    Values that either test rejects become NULL. Without ``apply`` nothing is written.
    """
    at = table.snapshot()
    types = {f.name: f.dataType for f in at.schema}
    text = tuple(c for c in numeric if isinstance(types.get(c), T.StringType))
    missing = tuple(c for c in numeric if c not in types)
    if not text:
        return RepairReport((), missing, {}, {}, False)
    rows = table.read(at=at)
    counts = {r.column_name: r for r in quality.convertibility(rows, text).collect()}
    if apply:
        table.replace(quality.repair_types(rows, text, target), [p.part for p in at.parts], at)
    return RepairReport(
        text, missing, {c: counts[c].bad_characters for c in text}, {c: counts[c].bad_casts for c in text}, apply
    )


# The numeric columns the audits look at.
NUMERIC_FLOW = quality.DECIMAL_NAMES
NUMERIC_BARS = ("open", "high", "low", "close", "amount")
