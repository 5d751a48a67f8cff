"""Conformed facts and the product dimension.

Facts exist in two forms. The ``fct_*`` functions read the staging views and hash
keys with null markers; the ``*_from_bronze`` functions read the cleansed tables,
where money is already rounded to cents and a key with a missing part is null.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions.keys import hashed_key, joined_key, number_rows
from shelfline.functions.measures import whole_days
from shelfline.operators.lookups import add_product, add_rate, add_store_key
from shelfline.sources.raw import stamp
from shelfline.sources.tables import conform


def _kg_sold() -> Column:
    return F.col("units_sold") * F.coalesce("unit_weight_kg", F.lit(0).cast(schemas.WEIGHT))


def _pipeline_qty() -> Column:
    return F.col("on_hand_qty") + F.col("in_transit_qty") + F.col("on_order_qty")


def _key_parts(day: str, store: str = "store_key") -> list[Column]:
    return [F.col("retailer_code"), F.col(store), F.col("upc"), F.col(day)]


def fct_pos_sales(
    staged: DataFrame, stores: DataFrame, products: DataFrame, fx: DataFrame, key_store: str = "store_key"
) -> DataFrame:
    """Sell-through with product attributes, weight and USD revenue.

    ``key_store="store_id"`` hashes the retailer's own store id instead, which keeps
    stores missing from the reference table apart.
    """
    rows = add_store_key(staged, stores)
    rows = add_product(rows, products, "upc", "unit_weight_kg", "brand", "category")
    rows = add_rate(rows, fx, F.col("transaction_date"), "currency_code", monthly=True)
    return rows.select(
        hashed_key(*_key_parts("transaction_date", key_store)).alias("pos_sale_sk"),
        "retailer_code",
        "store_key",
        "upc",
        "transaction_date",
        "units_sold",
        "revenue",
        (F.col("revenue") * F.col("rate_to_usd")).alias("revenue_usd"),
        _kg_sold().alias("kg_sold"),
        F.col("is_promo").alias("promo_flag"),
        "brand",
        "category",
        F.col("loaded_at").alias("_loaded_at"),
    )


def fct_pos_sales_from_bronze(cleansed: DataFrame, products: DataFrame) -> DataFrame:
    rows = add_product(cleansed, products, "upc", "unit_weight_kg", "brand", "category")
    return conform(
        rows.withColumns(
            {"pos_sale_sk": joined_key(*_key_parts("transaction_date")), "kg_sold": _kg_sold()}
        ),
        schemas.FCT_POS_SALES,
    )


def fct_inventory(staged: DataFrame, stores: DataFrame) -> DataFrame:
    return add_store_key(staged, stores).select(
        hashed_key(*_key_parts("snapshot_date")).alias("inventory_sk"),
        "retailer_code",
        "store_key",
        "upc",
        "snapshot_date",
        "on_hand_qty",
        "in_transit_qty",
        "on_order_qty",
        _pipeline_qty().alias("total_pipeline_qty"),
        F.col("loaded_at").alias("_loaded_at"),
    )


def fct_inventory_from_bronze(cleansed: DataFrame) -> DataFrame:
    return conform(
        cleansed.withColumns(
            {"inventory_sk": joined_key(*_key_parts("snapshot_date")), "total_pipeline_qty": _pipeline_qty()}
        ),
        schemas.FCT_INVENTORY,
    )


def fct_promotions(staged: DataFrame, products: DataFrame) -> DataFrame:
    return add_product(staged, products, "material_number", "upc").select(
        "promo_id",
        "promo_name",
        "retailer_code",
        "material_number",
        "upc",
        "start_date",
        "end_date",
        "promo_mechanic",
        "discount_pct",
        "trade_spend_usd",
        whole_days(F.col("start_date"), F.col("end_date")).alias("promo_duration_days"),
    )


def fct_promotions_loaded(
    staged: DataFrame, products: DataFrame, loaded_at: datetime | str | None = None
) -> DataFrame:
    """The same fact with its build time, in the declared table schema."""
    return conform(
        fct_promotions(staged, products).withColumn("_loaded_at", stamp(loaded_at)),
        schemas.FCT_PROMOTIONS,
    )


def dim_product_versions(
    products: DataFrame, updated_at: datetime | str | None = None, first_key: int = 1
) -> DataFrame:
    """All product versions with a surrogate number and the build time."""
    return numbered_product_versions(number_rows(products, "product_sk", ["material_number", "effective_from"], first_key - 1), updated_at)


def numbered_product_versions(numbered: DataFrame, updated_at: datetime | str | None = None) -> DataFrame:
    """The dimension of rows that have their number already."""
    return conform(numbered.withColumn("_updated_at", stamp(updated_at)), schemas.DIM_PRODUCT_VERSIONS)
