"""Ratios and means that are the same on every run.

Sums stay exact decimals or integers; only the last division is floating point,
so the result does not depend on how rows were split over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; null where the divisor is zero or null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean(value: Column, over: WindowSpec | None = None) -> Column:
    total, rows = F.sum(value), F.count(value)
    return ratio(total, rows) if over is None else ratio(total.over(over), rows.over(over))


def whole_days(start: Column, end: Column) -> Column:
    """Days covered, both ends counted."""
    return F.datediff(end, start) + 1
