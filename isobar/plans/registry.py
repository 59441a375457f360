"""All queries of the feeds and their DuckDB statements."""

from __future__ import annotations

from isobar.plans import details, grids, listings  # noqa: F401  registers
from isobar.plans.points import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
