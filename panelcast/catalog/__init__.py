"""Named queries over the test tables, each next to its DuckDB twin."""

from __future__ import annotations

from importlib import import_module

from panelcast.catalog.registry import ORACLES, QUERIES

MODULES = ["cleaning", "metering", "rolling", "diagnostics", "anomalies", "forecasts", "evaluation", "decisions", "similar"]


def load() -> tuple[dict, dict]:
    for name in MODULES:
        import_module(f"panelcast.catalog.{name}")
    return QUERIES, ORACLES
