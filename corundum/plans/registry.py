"""All queries of the core, by name."""

from __future__ import annotations

from corundum.plans import curation, data_quality

_MODULES = (curation, data_quality)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}
