"""Registered queries over the test tables, each with its check in plain SQL."""

from __future__ import annotations

from helixframe.registry import (
    cohort,
    filters,
    frequency,
    ingest,
    layouts,
    population,
    quality,
    scalars,
    streams,
)

MODULES = (scalars, filters, population, quality, frequency, cohort, ingest, streams, layouts)


def all_queries() -> dict:
    """Query callables by name: (spark, sf_dir) -> DataFrame."""
    found: dict = {}
    for module in MODULES:
        found.update(module.QUERIES)
    return found


def all_oracles() -> dict[str, str]:
    """Check statements by the same names."""
    found: dict[str, str] = {}
    for module in MODULES:
        found.update(module.ORACLES)
    return found
