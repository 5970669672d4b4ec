"""Registered queries: name -> (Spark query, SQL for DuckDB or None)."""

from __future__ import annotations

import importlib

MODULES = ("text", "tables", "measures", "search")


def all_entries() -> dict:
    entries = {}
    for module in MODULES:
        entries.update(importlib.import_module(f"{__name__}.{module}").ENTRIES)
    return entries
