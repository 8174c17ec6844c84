"""Exact money and portable averages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(12,2)"
TOTAL = "decimal(18,2)"


def total(col: Column | str) -> Column:
    """Exact sum as a grand total; wide enough for sums that exceed the row type."""
    col = F.col(col) if isinstance(col, str) else col
    return F.sum(col).cast(TOTAL)


def mean(sum_of: Column, count: Column) -> Column:
    """Average from an exact sum, rounded to six digits; NULL for no values."""
    return F.round(sum_of.cast("double") / F.nullif(count, F.lit(0)), 6)
