"""Typed views over the landing feeds. Nothing is written here, and nothing joined but layouts that were found."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.parsing import (
    AUTO_DATES,
    COMPACT,
    parse_date,
    parse_date_auto,
    parse_date_by_source,
    parse_date_named,
    parse_decimal,
    parse_integer,
    parse_wide_integer,
    upc_has_length,
    yes_flag,
)
from shelfline.operators.layouts import CANDIDATES, add_layout


def _lineage() -> list:
    return [F.col("_file_name").alias("source_file"), F.col("_loaded_at").alias("loaded_at")]


@dataclass(frozen=True)
class Layouts:
    """Date layouts of the feeds. A frame is what ``layouts.find_layouts`` returns for the feed."""

    sales: Mapping[str, str] | DataFrame | None = None  # by retailer; None: the fixed ones
    sales_default: tuple[str, ...] = AUTO_DATES  # tried for other retailers
    snapshots: tuple[str, ...] | DataFrame = AUTO_DATES
    promotions: tuple[str, ...] = AUTO_DATES


def type_pos(raw: DataFrame, layouts: Mapping[str, str] | DataFrame | None = None, default: tuple[str, ...] = AUTO_DATES) -> DataFrame:
    """Sell-through rows with typed twins of the text columns and ``rejection_reason``, null for accepted ones.

    One column decides, so accepted and rejected rows always add up to the input.
    """
    text = F.col("transaction_date")
    if isinstance(layouts, DataFrame):
        raw = add_layout(raw, layouts)
        typed_date = parse_date_named(text, F.col("_layout"), CANDIDATES, default)
    else:
        typed_date = parse_date_by_source(F.col("retailer_code"), text, layouts, default)
    units = F.col("typed_units_sold")
    return raw.withColumns(
        {
            "typed_date": typed_date,
            "typed_units_sold": parse_integer(F.col("units_sold")),
            "typed_revenue": parse_decimal(F.col("revenue"), 18, 2),
        }
    ).withColumn(
        "rejection_reason",
        F.when(~F.coalesce(upc_has_length(F.col("upc"), 12, 13), F.lit(False)), "INVALID_UPC")
        .when(parse_wide_integer(F.col("units_sold")).isNull(), "INVALID_UNITS")
        .when(units.isNull(), "UNITS_TOO_LARGE")
        .when(units < 0, "NEGATIVE_UNITS"),
    )


def stage_pos(raw: DataFrame, layouts: Mapping[str, str] | DataFrame | None = None, default: tuple[str, ...] = AUTO_DATES) -> DataFrame:
    """Sell-through rows with a plausible UPC and a unit count of zero or more.

    A date that cannot be read stays as null. The UPC is checked on its digits but
    passed on as sent. ``layouts`` names date layouts by retailer (a mapping, or what ``find_layouts`` found), ``default`` those tried for others.
    """
    return (
        type_pos(raw, layouts, default)
        .where(F.col("rejection_reason").isNull())
        .select(
            "retailer_code",
            "store_id",
            "upc",
            F.col("typed_date").alias("transaction_date"),
            F.col("typed_units_sold").alias("units_sold"),
            F.col("typed_revenue").alias("revenue"),
            "currency_code",
            yes_flag(F.col("promo_flag")).alias("is_promo"),
            *_lineage(),
        )
    )


def type_inventory(raw: DataFrame, layouts: tuple[str, ...] | DataFrame = AUTO_DATES) -> DataFrame:
    """Snapshots with typed twins of the text columns and ``rejection_reason``, null for accepted ones."""
    text = F.col("snapshot_date")
    if isinstance(layouts, DataFrame):
        raw, typed_date = add_layout(raw, layouts), parse_date_named(text, F.col("_layout"), CANDIDATES)
    else:
        typed_date = parse_date_auto(text, layouts)
    counts = ("on_hand_qty", "in_transit_qty", "on_order_qty")
    on_hand = F.col("typed_on_hand_qty")
    return raw.withColumns(
        {"typed_date": typed_date, **{f"typed_{c}": parse_integer(F.col(c)) for c in counts}}
    ).withColumn(
        "rejection_reason",
        F.when(F.col("typed_date").isNull(), "INVALID_DATE")
        .when(parse_wide_integer(F.col("on_hand_qty")).isNull(), "INVALID_QUANTITY")
        .when(on_hand.isNull(), "QUANTITY_TOO_LARGE")
        .when(on_hand < 0, "NEGATIVE_QUANTITY"),
    )


def stage_inventory(raw: DataFrame, layouts: tuple[str, ...] | DataFrame = AUTO_DATES) -> DataFrame:
    """Snapshots with a readable date and an on-hand count of zero or more."""
    return (
        type_inventory(raw, layouts)
        .where(F.col("rejection_reason").isNull())
        .select(
            "retailer_code",
            "store_id",
            "upc",
            F.col("typed_date").alias("snapshot_date"),
            *[F.col(f"typed_{c}").alias(c) for c in ("on_hand_qty", "in_transit_qty", "on_order_qty")],
            *_lineage(),
        )
    )


def stage_promo(raw: DataFrame, layouts: tuple[str, ...] = AUTO_DATES) -> DataFrame:
    """The promotion calendar, all rows."""
    return raw.select(
        "promo_id",
        "promo_name",
        "retailer_code",
        "material_number",
        parse_date_auto(F.col("start_date"), layouts).alias("start_date"),
        parse_date_auto(F.col("end_date"), layouts).alias("end_date"),
        "promo_mechanic",
        parse_decimal(F.col("discount_pct"), 5, 2).alias("discount_pct"),
        parse_decimal(F.col("trade_spend_usd"), 18, 2).alias("trade_spend_usd"),
        *_lineage(),
    )


def type_orders(raw: DataFrame) -> DataFrame:
    """Order rows with typed twins of the text columns and the verdict ``is_valid``.

    One column decides, so accepted and rejected rows always add up to the input.
    """
    return raw.withColumns(
        {
            "typed_order_date": parse_date(F.col("order_date"), COMPACT),
            "typed_delivery_date": parse_date(F.col("delivery_date"), COMPACT),
            "typed_order_qty": parse_decimal(F.col("order_qty"), 18, 3),
            "typed_net_value": parse_decimal(F.col("net_value"), 18, 2),
        }
    ).withColumn(
        "is_valid",
        F.col("typed_order_date").isNotNull()
        & F.col("typed_order_qty").isNotNull()
        & F.col("typed_net_value").isNotNull()
        & F.col("material_number").isNotNull()
        & F.col("record_id").isNotNull(),
    )
