"""All registered queries and oracles."""

from __future__ import annotations

from gridloom.checks import columns, files, series, totals  # noqa: F401  (importing registers the queries)
from gridloom.checks.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
