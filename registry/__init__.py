"""Every operator and table as a query on the given tables, with its expected result in SQL."""

from __future__ import annotations

from registry.base import QUERIES, SQL

from registry import (  # noqa: F401  (each module registers its queries)
    arriving,
    cleansing,
    defects,
    governance,
    layers,
    machine,
    relational,
    reports,
    scalar,
    serving,
    storage,
)

__all__ = ["QUERIES", "SQL"]
