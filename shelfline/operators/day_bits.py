"""Distinct days that add up: a bit per day of a month.

A count of distinct days can't be carried on when rows are added later; a month's days in one number can, since combining them again
changes nothing. The count is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_bits(rows: DataFrame, keys: list[str], day: str, month: str = "month") -> DataFrame:
    """By ``keys`` and month, ``days`` with a bit for each day that has a row; no bit for rows without a day."""
    bit = F.coalesce(F.expr(f"shiftleft(1, dayofmonth({day}) - 1)"), F.lit(0))
    return rows.groupBy(*keys, F.trunc(day, "month").alias(month)).agg(F.bit_or(bit).alias("days"))


def merged_bits(parts: list[DataFrame], keys: list[str], month: str = "month") -> DataFrame:
    """The days of several tables of bits together."""
    return reduce(DataFrame.unionByName, parts).groupBy(*keys, month).agg(F.bit_or("days").alias("days"))


def distinct_days(bits: DataFrame, keys: list[str], month: str = "month") -> DataFrame:
    """How many distinct days each value of ``keys`` has; fewer keys than the bits have are combined first."""
    by_month = bits.groupBy(*keys, month).agg(F.bit_or("days").alias("days"))
    return by_month.groupBy(*keys).agg(F.sum(F.bit_count("days")).alias("selling_days"))
