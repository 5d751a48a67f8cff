"""Joins of facts to reference tables.

The joins themselves carry no hint: Spark broadcasts a reference table while its size
is below ``spark.sql.autoBroadcastJoinThreshold``. ``if_small`` decides by the rows
instead: it raises that limit for a table that it has measured, and keeps Spark from
broadcasting one beyond its own limit, because Spark goes by the size of the files, and
a packed file takes many times as much in memory. Past the limit the join is a
sort-merge join whose hot keys AQE splits (the fact is always the side that may be split).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfline.schemas import RATE


# Of a broadcast table as measured below. The driver holds it two or three times over, hashed and in blocks, and several at once.
BROADCAST_LIMIT = 64 * 1024 * 1024


def is_small(table: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether the rows of a table take up at most ``limit`` bytes.

    Measured by one aggregation over the table: eight bytes a column plus the bytes of its texts.
    """
    texts = [f.name for f in table.schema.fields if isinstance(f.dataType, StringType)]
    row = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(16 + 8 * len(table.columns)))
    size = table.agg(F.sum(row.cast("bigint"))).first()[0] or 0
    return size <= limit


def if_small(table: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The table, marked for broadcast if it ``is_small`` and for a sort-merge join if not. The mark lasts through filters and projections."""
    return F.broadcast(table) if is_small(table, limit) else table.hint("merge")


def current_products(products: DataFrame) -> DataFrame:
    return products.where(F.col("is_current"))


def add_store_key(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Left join on the retailer's own store id."""
    return fact.join(
        stores.select("retailer_code", "store_id", "store_key"), ["retailer_code", "store_id"], "left"
    )


def add_product(fact: DataFrame, products: DataFrame, on: str, *columns: str, how: str = "left") -> DataFrame:
    """Attributes of the current product version, found by ``upc`` or ``material_number``."""
    return fact.join(current_products(products).select(on, *columns), on, how)


def add_rate(
    fact: DataFrame, fx: DataFrame, day: Column, currency: str, monthly: bool
) -> DataFrame:
    """``rate_to_usd`` of the day, or of the first of its month; 1 where none is known.

    ``rate_found`` tells the two apart.
    """
    rates = fx.select(
        F.col("rate_date").alias("_rate_day"),
        F.col("currency_code").alias("_rate_currency"),
        F.col("rate_to_usd").alias("_rate"),
    )
    wanted = F.trunc(day, "month") if monthly else day
    return (
        fact.withColumn("_wanted_day", wanted)
        .join(
            rates,
            (F.col("_wanted_day") == F.col("_rate_day")) & (F.col(currency) == F.col("_rate_currency")),
            "left",
        )
        .withColumn("rate_found", F.col("_rate").isNotNull())
        .withColumn("rate_to_usd", F.coalesce("_rate", F.lit(1).cast(RATE)))
        .drop("_wanted_day", "_rate_day", "_rate_currency", "_rate")
    )


def add_product_as_of(fact: DataFrame, products: DataFrame, day: str, *columns: str) -> DataFrame:
    """The product version valid on ``day``: equality on material, range as residual."""
    versions = products.select(
        F.col("material_number").alias("_material"),
        F.col("effective_from").alias("_from"),
        F.col("effective_to").alias("_to"),
        *[F.col(c).alias(f"product_{c}") for c in columns],
    )
    return fact.join(
        versions,
        (F.col("material_number") == F.col("_material")) & F.col(day).between(F.col("_from"), F.col("_to")),
        "left",
    ).drop("_from", "_to")


def join_folded(fact: DataFrame, folded: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join to a table that was grouped by the same ``keys``; ``fact`` has no null in them.

    AQE splits a hot key only between two plain shuffles. Under an ordinary equality the
    grouped side would reuse the shuffle of its grouping and the hot key of ``fact``
    would stay in one task; the null-safe form makes Spark shuffle the folded rows again.
    """
    renamed = folded.withColumnsRenamed({k: f"_folded_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_folded_{k}")) for k in keys]
    return fact.join(renamed, same, how).drop(*[f"_folded_{k}" for k in keys])


def price_by_brand(products: DataFrame) -> DataFrame:
    """One price per kg for each brand: that of its lowest current material number."""
    return (
        current_products(products)
        .groupBy("brand")
        .agg(F.min_by("avg_price_per_kg", "material_number").alias("brand_price_per_kg"))
    )


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str, include_null: bool = False) -> DataFrame:
    """Child keys without a parent, with the number of child rows that carry each.

    Keys are counted before the join, so one key on a third of the rows costs one row.
    """
    keys = child if include_null else child.where(F.col(column).isNotNull())
    known = parent.select(F.col(parent_column).alias("_parent"))
    return (
        keys.groupBy(column)
        .agg(F.count("*").alias("rows"))
        .join(known, F.col(column) == F.col("_parent"), "left_anti")
    )
