"""Surrogate numbers that last: a stored map from natural keys to numbers, which only grows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.keys import number_rows
from shelfline.operators.lookups import if_small
from shelfline.sources.tables import overwrite, read_table, table_exists

RANGES = "load long, first long, last long"


def _same_key(key: list[str]) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key])


def allocate(rows: DataFrame, path: str, name: str, natural_key: list[str], start: int = 0) -> DataFrame:
    """The map of ``natural_key`` to ``name`` after keys of ``rows`` that are new got the numbers after the last one given out.

    Every load with new keys writes them to a folder of its own and then its range of numbers, one small row: only loads with
    a range count, so one that died is written again with the same numbers. The last number is taken from the ranges; the map is read for its
    keys only. New keys are numbered in their order; a null part is a value like any other. A map has one writer at a time.
    """
    spark = rows.sparkSession
    ranges = read_table(spark, f"{path}/ranges").collect() if table_exists(spark, f"{path}/ranges") else []
    load, last = (max(r["load"] for r in ranges) + 1, max(r["last"] for r in ranges)) if ranges else (0, start)
    folders = [f"{path}/keys/load={r['load']}" for r in ranges]
    keys = rows.select(*natural_key).distinct()
    if folders:
        held = spark.read.parquet(*folders).select(*[F.col(c).alias(f"_key_{c}") for c in natural_key])
        keys = keys.join(held, _same_key(natural_key), "left_anti")
    found = overwrite(number_rows(keys, name, natural_key, last), f"{path}/keys/load={load}")
    if found:
        overwrite(spark.createDataFrame([(load, last + 1, last + found)], RANGES).coalesce(1), f"{path}/ranges/of={load}")
        folders.append(f"{path}/keys/load={load}")
    # Without any key there is still the empty folder of this load.
    return spark.read.parquet(*(folders or [f"{path}/keys/load={load}"]))


def with_numbers(rows: DataFrame, numbers: DataFrame, natural_key: list[str]) -> DataFrame:
    """``rows`` with the number of their key, as the first column."""
    name = next(c for c in numbers.columns if c not in natural_key)
    known = if_small(numbers.withColumnsRenamed({c: f"_key_{c}" for c in natural_key}))
    return rows.join(known, _same_key(natural_key), "left").select(name, *rows.columns)
