"""Registered queries, by theme."""

from __future__ import annotations

import importlib

MODULES = ["web", "texts", "copies", "feeds", "binary", "watching", "folders"]


def registered() -> dict:
    """All queries, each with its SQL where it has one."""
    found: dict = {}
    for module in MODULES:
        for name, item in importlib.import_module(f"deckmill.catalog.{module}").CATALOG.items():
            if name in found:
                raise ValueError(f"query {name} registered twice")
            found[name] = item
    return found
