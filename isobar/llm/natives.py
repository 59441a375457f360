"""Column expressions that several operators share; JVM-side only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def fenced(text: Column, separators: str) -> Column:
    """Words between separators, with one x before and after; a null text has no words."""
    return F.split(F.concat(F.lit("x "), F.coalesce(text, F.lit("")), F.lit(" x")), separators, -1)


def word_count(text: Column) -> Column:
    return (F.size(fenced(text, SPACES)) - 2).cast("long")


def small(df: DataFrame, rows: int) -> bool:
    """Whether the table has at most so many rows; looks at no more than that many."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it is small; else joins shuffle."""
    return F.broadcast(df) if small(df, rows) else df
