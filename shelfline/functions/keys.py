"""Hash keys and surrogate numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.sources.tables import stored

# Fixed value: stands for a null part in a hashed key.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def joined_key(*parts: Column) -> Column:
    """md5 of the parts joined by ``|``; null as soon as one part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("|"), part.cast("string")]
    return F.md5(F.concat(*pieces[1:]))


def hashed_key(*parts: Column) -> Column:
    """md5 of the parts joined by ``-``; a null part counts as a marker text."""
    return F.md5(
        F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts])
    )


def number_rows(df: DataFrame, name: str, natural_key: list[str], start: int = 0) -> DataFrame:
    """Dense numbers ``start+1 ..`` in the order of the natural key, without sorting the table in one task.

    Rows are dealt to ranges of the natural key and the ranges are written; each is numbered by itself
    and moved up by the size of those before it, so the only ungrouped window runs over one row per
    range. Equal rows are folded into one with a count and get consecutive numbers. Rows of one
    key are in order of their other columns.
    """
    rest = [c for c in df.columns if c not in natural_key]
    folded = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    ranged = stored(folded.repartitionByRange(*natural_key).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum("_copies").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy("_range").orderBy(*natural_key, *rest).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranged.withColumn("_ahead", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(
        F.broadcast(offsets), "_range"  # as many rows as shuffle partitions
    )
    # Copies are spelled out in runs of 10,000; if any row has more, the runs are spread over tasks in between.
    runs = placed.withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(_copies - 1) div 10000")))
    )
    in_run = F.least(F.lit(10000), F.col("_copies") - F.col("_run") * 10000).cast("int")
    number = F.lit(start) + F.col("_offset") + F.col("_ahead") + F.col("_run") * 10000
    if (ranged.agg(F.max("_copies")).first()[0] or 0) > 10000:
        runs = runs.hint("rebalance")
    return runs.select(
        F.explode(F.transform(F.sequence(F.lit(1), in_run), lambda i: number + i)).alias(name), *df.columns
    )


def keep_numbers(df: DataFrame, known: DataFrame, name: str, natural_key: list[str]) -> DataFrame:
    """``df`` with the numbers that ``known`` has for its natural keys; new keys get the next ones.

    Numbers stay when other columns change and are not given twice. ``known`` has one row per key.
    """
    held = known.select(*natural_key, name)
    top = held.agg(F.max(name)).first()[0] or 0
    met = df.join(held, natural_key, "left").select(name, *df.columns)
    fresh = df.join(held, natural_key, "left_anti")
    return met.where(F.col(name).isNotNull()).unionByName(number_rows(fresh, name, natural_key, top))


def hash_number(*parts: str) -> Column:
    """64-bit hash as a surrogate for dimensions too large to number densely."""
    return F.xxhash64(*parts)
