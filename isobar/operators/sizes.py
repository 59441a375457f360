"""Broadcasts behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 100_000


def maybe_broadcast(df: DataFrame, rows: int = ROWS) -> DataFrame:
    """Marked for broadcast if it has at most so many rows (no more are looked at); else joins shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def met(exploded: DataFrame, others: DataFrame, on: list[str], rows: int = ROWS) -> DataFrame:
    """Inner join of rows from an explode, whose size the planner takes for that before it: ``others`` is broadcast if it is small, else both sides are shuffled."""
    small = others.limit(rows + 1).count() <= rows
    return exploded.join(others.hint("broadcast" if small else "merge"), on)
