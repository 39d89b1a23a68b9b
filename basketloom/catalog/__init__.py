"""Every operator as a query over the test tables, next to its SQL check."""

from __future__ import annotations

import importlib

_MODULES = [
    "sourcing", "checking", "shaping", "imputing", "joining", "grouping", "windowing", "scalars", "features", "learning", "dataflow",
]


def load():
    """All queries and all SQL checks, by name."""
    for name in _MODULES:
        importlib.import_module(f"basketloom.catalog.{name}")
    from basketloom.catalog.registry import CHECKS, QUERIES

    return dict(QUERIES), dict(CHECKS)
