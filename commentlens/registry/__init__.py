"""Registered queries over the generated tables and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("people", "columns", "activity", "language", "nested", "loading", "matrices")


def _entries() -> dict:
    found: dict = {}
    for name in MODULES:
        for key, value in import_module(f"{__name__}.{name}").ENTRIES.items():
            if key in found:
                raise ValueError(f"query {key} is registered twice")
            found[key] = value
    return found


def queries() -> dict:
    return {name: fn for name, (fn, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql is not None}
