"""Landing feeds to typed bronze tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions.measures import ratio
from shelfline.functions.parsing import (
    ISO,
    digits,
    parse_date_by_source,
    parse_decimal,
    parse_integer,
    strict_date_by_source,
    strict_float,
    strict_integer,
    tidy_code,
)
from shelfline.operators.lookups import add_product, add_rate, add_store_key
from shelfline.plans.staging import Layouts, stage_inventory, stage_pos, type_inventory, type_orders, type_pos
from shelfline.sources.raw import day, stamp
from shelfline.sources.tables import conform


def accepted_orders(typed: DataFrame, staged_at: datetime | str | None = None) -> DataFrame:
    rows = typed.where("is_valid").withColumns(
        {
            "order_date": F.col("typed_order_date"),
            "delivery_date": F.col("typed_delivery_date"),
            "order_qty": F.col("typed_order_qty"),
            "net_value": F.col("typed_net_value"),
            "_source_file": F.col("_file_name"),
            "_staged_at": stamp(staged_at),
        }
    )
    return conform(rows, schemas.ORDERS_STAGED)


def rejected_orders(typed: DataFrame, rejected_at: datetime | str | None = None) -> DataFrame:
    """Rejected rows as sent, with the first rule each one breaks."""
    reason = (
        F.when(F.col("typed_order_date").isNull(), "INVALID_DATE")
        .when(F.col("typed_order_qty").isNull(), "INVALID_QUANTITY")
        .when(F.col("typed_net_value").isNull(), "INVALID_NET_VALUE")
        .when(F.col("material_number").isNull(), "NULL_MATERIAL")
        .when(F.col("record_id").isNull(), "NULL_RECORD_ID")
        .otherwise("UNKNOWN")
    )
    rows = typed.where(~F.col("is_valid")).select(
        "record_id",
        F.col("order_date").alias("raw_order_date"),
        F.col("order_qty").alias("raw_order_qty"),
        F.col("net_value").alias("raw_net_value"),
        "material_number",
        reason.alias("rejection_reason"),
        stamp(rejected_at).alias("_rejected_at"),
    )
    return conform(rows, schemas.ORDERS_REJECTED)


def stage_orders(raw: DataFrame, staged_at: datetime | str | None = None) -> DataFrame:
    return accepted_orders(type_orders(raw), staged_at)


def quarantine_orders(raw: DataFrame, rejected_at: datetime | str | None = None) -> DataFrame:
    return rejected_orders(type_orders(raw), rejected_at)


def order_counts(raw: DataFrame) -> DataFrame:
    """Accepted and rejected row counts with the message a run reports, in one pass."""
    return (
        type_orders(raw)
        .agg(F.count_if("is_valid").alias("staged"), F.count_if(~F.col("is_valid")).alias("rejected"))
        .select(
            "staged",
            "rejected",
            F.format_string("Staged: %d rows. Rejected: %d rows.", "staged", "rejected").alias("message"),
        )
    )


def rejected_pos(raw: DataFrame, rejected_at: datetime | str | None = None, layouts: Layouts = Layouts()) -> DataFrame:
    """Sell-through rows that ``cleanse_pos`` leaves out, as sent, with the first rule each one breaks."""
    rows = type_pos(raw, layouts.sales, layouts.sales_default).where(F.col("rejection_reason").isNotNull())
    return rows.select(*schemas.RAW_POS.names, "rejection_reason", stamp(rejected_at).alias("_rejected_at"))


def rejected_inventory(raw: DataFrame, rejected_at: datetime | str | None = None, layouts: Layouts = Layouts()) -> DataFrame:
    """Snapshots that ``cleanse_inventory`` leaves out, as sent, with the first rule each one breaks."""
    rows = type_inventory(raw, layouts.snapshots).where(F.col("rejection_reason").isNotNull())
    return rows.select(*schemas.RAW_INVENTORY.names, "rejection_reason", stamp(rejected_at).alias("_rejected_at"))


def cleanse_pos(raw: DataFrame, stores: DataFrame, fx: DataFrame, layouts: Layouts = Layouts()) -> DataFrame:
    """Valid sell-through with store key and revenue in USD at the rate of the month's first day."""
    rows = add_store_key(stage_pos(raw, layouts.sales, layouts.sales_default), stores)
    rows = add_rate(rows, fx, F.col("transaction_date"), "currency_code", monthly=True)
    return conform(
        rows.withColumns(
            {
                "revenue_usd": F.col("revenue") * F.col("rate_to_usd"),
                "promo_flag": F.col("is_promo"),
                "_source_file": F.col("source_file"),
                "_loaded_at": F.col("loaded_at"),
            }
        ),
        schemas.POS_CLEANSED,
    )


def cleanse_inventory(raw: DataFrame, stores: DataFrame, layouts: Layouts = Layouts()) -> DataFrame:
    rows = add_store_key(stage_inventory(raw, layouts.snapshots), stores)
    return conform(
        rows.withColumns({"_source_file": F.col("source_file"), "_loaded_at": F.col("loaded_at")}),
        schemas.INVENTORY_CLEANSED,
    )


def pos_quality_audit(cleansed: DataFrame, as_of: datetime | str | None = None, hours: int = 1) -> DataFrame:
    """One log row about the rows loaded in the last ``hours`` before ``as_of``."""
    now = stamp(as_of)
    return conform(
        cleansed.where(F.col("_loaded_at") >= now - F.expr(f"interval {int(hours)} hours"))
        .agg(
            F.count("*").alias("total_rows"),
            F.count_if(F.col("store_key").isNull()).alias("null_store_key_count"),
            F.count_if(F.col("transaction_date") > day(as_of)).alias("future_date_count"),
            F.count_if(F.col("revenue") < 0).alias("negative_revenue_count"),
        )
        .withColumn("audit_timestamp", now),
        schemas.POS_QUALITY_LOG,
    )


def _unreadable(raw: DataFrame) -> Column:
    """What the strict job could not read in a row; null if it can read all of it."""
    code = tidy_code(F.col("retailer_code"))
    return (
        F.when(parse_integer(F.col("units_sold")).isNull(), "UNREADABLE_UNITS")
        .when(parse_decimal(F.col("revenue"), 18, 2).isNull(), "UNREADABLE_REVENUE")
        .when(parse_date_by_source(code, F.col("transaction_date"), default=(ISO,)).isNull(), "UNREADABLE_DATE")
    )


def readable_pos(raw: DataFrame) -> DataFrame:
    """The rows of a feed that ``strict_pos`` can read; ``unreadable_pos`` has all others.

    Write the result before the strict job reads it: Spark may run a strict cast ahead of this filter if
    both are in one plan.
    """
    return raw.where(_unreadable(raw).isNull())


def unreadable_pos(raw: DataFrame, rejected_at: datetime | str | None = None) -> DataFrame:
    reason = _unreadable(raw)
    return raw.where(reason.isNotNull()).select(
        *schemas.RAW_POS.names, reason.alias("rejection_reason"), stamp(rejected_at).alias("_rejected_at")
    )


def strict_pos(raw: DataFrame) -> DataFrame:
    """Sell-through with tidied codes and strict typing: text that does not parse fails the job."""
    return (
        raw.select(
            tidy_code(F.col("retailer_code")).alias("retailer_code"),
            F.trim("store_id").alias("store_id"),
            digits(F.col("upc")).alias("upc"),
            "transaction_date",
            strict_integer(F.col("units_sold")).alias("units_sold"),
            strict_float(F.col("revenue")).alias("revenue"),
            "currency_code",
            "promo_flag",
            "_file_name",
            "_loaded_at",
        )
        .where((F.length("upc") == 12) & (F.col("units_sold") >= 0) & (F.col("revenue") >= 0))
        .withColumn("sale_date", strict_date_by_source(F.col("retailer_code"), F.col("transaction_date")))
    )


def enrich_pos(raw: DataFrame, products: DataFrame) -> DataFrame:
    """Strictly typed sell-through with product attributes, weight and revenue per kg."""
    kg = F.col("units_sold") * F.col("unit_weight_kg")
    return add_product(
        strict_pos(raw), products, "upc", "brand", "category", "unit_weight_kg", "product_name"
    ).withColumns({"kg_sold": kg, "revenue_per_kg": ratio(F.col("revenue"), kg)})


def latest_sales(enriched: DataFrame, rows: int = 20) -> DataFrame:
    """The newest sales for a first look. Unknown dates come first; ties follow the columns."""
    shown = [
        "retailer_code", "store_id", "upc", "sale_date", "product_name", "brand",
        "units_sold", "kg_sold", "revenue", "revenue_per_kg", "promo_flag",
    ]
    ties = [F.asc_nulls_last(c) for c in shown if c != "sale_date"]
    return enriched.select(*shown).orderBy(F.desc_nulls_first("sale_date"), *ties).limit(rows)
