"""All registered checks."""

from __future__ import annotations

from importlib import import_module

from .base import ORACLES, QUERIES, Query

MODULES = ("calendar_checks", "cleaning_checks", "merge_checks", "planning_checks", "quality_checks", "job_checks", "analysis_checks", "event_checks")


def _load() -> None:
    for name in MODULES:
        import_module(f"{__package__}.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
