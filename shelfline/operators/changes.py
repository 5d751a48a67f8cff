"""What changed between two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def net_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows with ``copies``, how many more of them ``new`` has than ``old``; rows with equally many are left out.

    Equal rows are added up before the one shuffle, so a group of copies is never gathered.
    """
    columns = new.columns
    return (
        old.select(*columns, F.lit(-1).cast("bigint").alias("copies"))
        .unionByName(new.select(*columns, F.lit(1).cast("bigint").alias("copies")))
        .groupBy(*columns)
        .agg(F.sum("copies").alias("copies"))
        .where("copies <> 0")
    )


def change_of(copies: str = "copies") -> Column:
    return F.when(F.col(copies) > 0, "INSERT").otherwise("DELETE").alias("change")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to remove from ``old`` and to add to reach ``new``.

    ``change`` is INSERT or DELETE; ``is_update`` marks the two halves of an update (a
    key that loses one row version and gains another); ``copies`` counts equal rows.
    Equal rows are counted with map-side sums and cancel out, so neither a key nor a
    group of copies is ever gathered or paired with itself, and only changed rows
    reach the second step. Spark leaves that step out if ``is_update`` is not read.
    """
    columns = new.columns
    net = net_rows(old, new)
    # A struct is never null, so plain equality pairs null keys too, and Spark can tell that a row meets one key.
    key = F.struct(*keys)
    signs = net.groupBy(key.alias("_key")).agg((F.bool_or(F.col("copies") > 0) & F.bool_or(F.col("copies") < 0)).alias("is_update"))
    # As many as changed keys, which the size of the files doesn't tell; the hash makes Spark shuffle them again, so that AQE splits a hot key.
    signs = signs.withColumn("_hash", F.xxhash64("_key")).hint("merge")
    return net.join(signs, (key == F.col("_key")) & (F.xxhash64(key) == F.col("_hash")), "left").select(
        change_of(), "is_update", F.abs("copies").alias("copies"), *columns
    )
