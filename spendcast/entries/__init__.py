"""Queries over the driver tables, each with SQL that must give the same rows."""

from __future__ import annotations

from spendcast.entries import features, loading, relational, scenarios, scoring, training
from spendcast.entries.common import Entry

_MODULES = (relational, features, scoring, scenarios, training, loading)


def all_entries() -> dict[str, Entry]:
    """Every registered query by name."""
    entries: dict[str, Entry] = {}
    for module in _MODULES:
        for name, entry in module.ENTRIES.items():
            if name in entries:
                raise ValueError(f"query {name} is registered twice")
            entries[name] = entry
    return entries
