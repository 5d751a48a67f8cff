"""The four gold datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.measures import mean, ratio, whole_days
from shelfline.operators.lookups import (
    add_product,
    add_product_as_of,
    add_rate,
    current_products,
    join_folded,
    price_by_brand,
)
from shelfline.operators.promo_days import daily_sales, on_any_promo_day, on_promo, retailer_days, running, without_promo
from shelfline.sources.raw import day
from shelfline.sources.tables import stored


# What conformed sales read of a product version.
PRODUCT_OF_ORDER = ("material_number", "effective_from", "effective_to", "upc", "product_name", "brand", "category", "sub_category", "unit_weight_kg")


def conformed_sales(orders: DataFrame, products: DataFrame, fx: DataFrame) -> DataFrame:
    """Orders with the product version of their day, weight, and value in USD.

    Rates are looked up on the exact order date; without one the value is taken as is.
    """
    *described, weight = PRODUCT_OF_ORDER[3:]
    rows = add_product_as_of(orders, products, "order_date", *described, weight)
    rows = add_rate(rows, fx, F.col("order_date"), "currency", monthly=False)
    return rows.select(
        F.col("record_id").alias("sales_order_id"),
        "sales_org",
        "distribution_channel",
        "order_type",
        "order_date",
        "delivery_date",
        "plant",
        F.col("_material").alias("material_number"),
        *[F.col(f"product_{c}").alias(c) for c in described],
        "order_qty",
        "order_qty_uom",
        (F.col("order_qty") * F.col("product_unit_weight_kg")).alias("order_weight_kg"),
        "net_value",
        "currency",
        (F.col("net_value") * F.col("rate_to_usd")).alias("net_value_usd"),
        "customer_number",
        F.col("_staged_at").alias("source_timestamp"),
    )


def rows_without_rate(fact: DataFrame, fx: DataFrame, date: str, currency: str, monthly: bool) -> DataFrame:
    """Per currency, how many rows fell back to a rate of 1."""
    return (
        add_rate(fact, fx, F.col(date), currency, monthly)
        .groupBy(currency)
        .agg(F.count("*").alias("rows"), F.count_if(~F.col("rate_found")).alias("without_rate"))
    )


def weekly_store_demand(pos: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Units, weight and revenue per week, store and product group. Weeks start on Monday.

    The fact is folded to store, product and day before any join, so that only these sums are shuffled to large
    reference tables. The days of a week are bits of one number, so weeks are added up before their one shuffle and
    the distinct day count needs no step by day.
    """
    place = ("retailer_name", "region", "store_name", "store_id")
    group = ("brand", "category", "sub_category")
    sales = pos.groupBy("store_key", "upc", "transaction_date").agg(
        F.sum("units_sold").alias("units"), F.sum("revenue_usd").alias("revenue")
    )
    rows = sales.join(stores.select("store_key", *place), "store_key")
    rows = add_product(rows, products, "upc", *group, "unit_weight_kg", how="inner")
    weekday_bit = F.expr("shiftleft(1, weekday(transaction_date))")
    return (
        rows.groupBy(F.trunc("transaction_date", "week").alias("week_start"), *place, *group)
        .agg(
            F.sum("units").alias("total_units"),
            F.sum(F.col("units") * F.col("unit_weight_kg")).alias("total_kg"),
            F.sum("revenue").alias("total_revenue_usd"),
            F.coalesce(F.bit_count(F.bit_or(weekday_bit)), F.lit(0)).cast("bigint").alias("selling_days"),
        )
        .withColumn("avg_daily_kg", ratio(F.col("total_kg"), F.col("selling_days")))
    )


def promo_sales(daily: DataFrame, promos: DataFrame, products: DataFrame, by_upc: bool = False, days: DataFrame | None = None) -> DataFrame:
    """Units, weight and revenue of each promotion inside its window; ``promos`` as from ``running``.

    With ``retailer_days`` of these promotions, or of more, sales on other days are left out before the join.
    """
    calendar = promos.drop("upc").join(
        current_products(products).select("material_number", "upc", "brand", "category", "unit_weight_kg"),
        "material_number",
    )
    return (
        on_promo(on_any_promo_day(daily, days), calendar)
        .groupBy(
            "promo_id", "promo_name", "promo_mechanic", "retailer_code", "trade_spend_usd", "discount_pct",
            "start_date", "end_date",
            whole_days(F.col("start_date"), F.col("end_date")).alias("promo_days"),
            "brand", "category", *(["upc"] if by_upc else []),
        )
        .agg(
            F.sum("day_units").alias("promo_units"),
            F.sum(F.col("day_units") * F.col("unit_weight_kg")).alias("promo_kg"),
            F.sum("day_revenue_usd").alias("promo_revenue"),
        )
    )


def baseline_sales(daily: DataFrame, promos: DataFrame, products: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Mean weight per sales row, by product and retailer, over days without any promotion.

    ``promos`` as from ``running``, ``days`` their ``retailer_days``, computed if not given. A product weighs the same every
    day, so its days are added up before the lookup of weights.
    """
    weights = current_products(products).select("upc", "unit_weight_kg")
    weighed = F.col("unit_weight_kg").isNotNull()
    days = retailer_days(promos) if days is None else days
    return (
        without_promo(daily, promos, days)
        .groupBy("upc", "retailer_code")
        .agg(F.sum("day_units").alias("units"), F.sum("day_rows").alias("rows"))
        .join(weights, "upc")
        .groupBy("upc", "retailer_code")
        .agg(
            ratio(
                F.sum(F.col("units") * F.col("unit_weight_kg")),
                F.sum(F.when(weighed, F.col("rows"))),
            ).alias("baseline_daily_kg")
        )
    )


def _lift_inputs(promos, products, pos, daily) -> tuple[DataFrame, DataFrame]:
    """Promotion sums with the brand's price, and baselines. The fact is read once: its daily sums are stored."""
    daily = stored(daily_sales(pos), "daily_sales") if daily is None else daily
    calendar = running(promos, daily)
    days = retailer_days(calendar)
    return _priced_sales(calendar, products, daily, days), baseline_sales(daily, calendar, products, days)


def _priced_sales(promos: DataFrame, products: DataFrame, daily: DataFrame, days: DataFrame | None) -> DataFrame:
    return promo_sales(daily, promos, products, by_upc=True, days=days).join(price_by_brand(products), "brand", "left")


_PROMO = (
    "promo_id", "promo_name", "promo_mechanic", "retailer_code", "brand", "category", "start_date", "end_date",
    "promo_days", "trade_spend_usd", "brand_price_per_kg",
)


def promo_lift(
    promos: DataFrame, products: DataFrame, pos: DataFrame | None = None, daily: DataFrame | None = None
) -> DataFrame:
    """Promotion sales against the product's own baseline, with lift, extra revenue and return on spend.

    One row per promotion and product. Pass ``daily``, as ``daily_sales`` makes it, if such a table is at hand.
    """
    return _lift(*_lift_inputs(promos, products, pos, daily))


def lift_of(promos: DataFrame, calendar: DataFrame, products: DataFrame, daily: DataFrame) -> DataFrame:
    """``promo_lift`` of some promotions, from the daily sums of their products at their retailers.

    ``calendar`` are all promotions; both as from ``running``.
    """
    days = retailer_days(calendar)
    return _lift(_priced_sales(promos, products, daily, days), baseline_sales(daily, calendar, products, days))


def _lift(summary: DataFrame, baseline: DataFrame) -> DataFrame:
    base, days = F.col("baseline_daily_kg"), F.col("promo_days")
    usual_revenue = base * days * F.col("brand_price_per_kg").cast("double")
    return (
        join_folded(summary, baseline, ["retailer_code", "upc"])
        .withColumn("promo_daily_kg", ratio(F.col("promo_kg"), days))
        .withColumn("lift_pct", ratio(F.col("promo_daily_kg") - base, base))
        .withColumn("incremental_revenue_est", F.col("promo_revenue").cast("double") - usual_revenue)
        .withColumn("promo_roi", ratio(F.col("incremental_revenue_est"), F.col("trade_spend_usd")))
        .select(
            "promo_id", "promo_name", "promo_mechanic", "retailer_code", "brand", "category",
            "start_date", "end_date", "promo_days", "promo_kg", "promo_daily_kg",
            "baseline_daily_kg", "lift_pct", "promo_revenue", "trade_spend_usd",
            "incremental_revenue_est", "promo_roi",
        )
    )


def promo_lift_by_retailer(
    promos: DataFrame, products: DataFrame, pos: DataFrame | None = None, daily: DataFrame | None = None
) -> DataFrame:
    """Promotion sales against the baselines of all products of the retailer.

    Setting a promotion against each product of its retailer would give a row per pair. All that a report asks of these
    rows is linear in the baseline or in one over it, so the retailer's baselines are folded first, to a count and two
    means, and each promotion is one row: the mean lift, extra revenue and return over its retailer's products. Measures
    with a baseline are rounded to six places, since means of doubles depend on their order.
    """
    summary, baseline = _lift_inputs(promos, products, pos, daily)
    base, days = F.col("base"), F.col("promo_days")
    folded = baseline.groupBy("retailer_code").agg(
        F.count("baseline_daily_kg").alias("products"),
        F.avg("baseline_daily_kg").alias("base"),
        F.avg(ratio(F.lit(1), F.col("baseline_daily_kg"))).alias("inverse"),
    )
    totals = summary.groupBy(*_PROMO).agg(F.sum("promo_kg").alias("promo_kg"), F.sum("promo_revenue").alias("promo_revenue"))
    extra = F.col("promo_revenue").cast("double") - base * days * F.col("brand_price_per_kg").cast("double")
    return (
        join_folded(totals, folded, ["retailer_code"])
        .withColumn("promo_daily_kg", ratio(F.col("promo_kg"), days))
        .withColumn("extra", extra)
        .select(
            "promo_id", "promo_name", "promo_mechanic", "retailer_code", "brand", "category",
            "start_date", "end_date", "promo_days", "promo_kg", "promo_daily_kg",
            F.coalesce("products", F.lit(0)).alias("products"),
            F.round(base, 6).alias("baseline_daily_kg"),
            F.round(F.col("promo_daily_kg") * F.col("inverse") - 1, 6).alias("lift_pct"),
            "promo_revenue", "trade_spend_usd",
            F.round("extra", 6).alias("incremental_revenue_est"),
            F.round(ratio(F.col("extra"), F.col("trade_spend_usd")), 6).alias("promo_roi"),
        )
    )


def recent_demand(pos: DataFrame, as_of: str | None = None, days: int = 28) -> DataFrame:
    """Mean units per sales row of the last ``days``, by store and product."""
    return (
        pos.where(F.col("transaction_date") >= F.date_sub(day(as_of), days))
        .groupBy("store_key", "upc")
        .agg(mean(F.col("units_sold")).alias("avg_daily_units"))
    )


def stock_status(on_hand: Column, days_of_supply: Column) -> Column:
    # The status names and their limits in days.
    return (
        F.when(on_hand == 0, "OUT_OF_STOCK")
        .when(days_of_supply < 3, "CRITICAL")
        .when(days_of_supply < 7, "LOW")
        .when(days_of_supply > 28, "OVERSTOCK")
        .otherwise("HEALTHY")
    )


def on_shelf_availability(
    inventory: DataFrame, stores: DataFrame, products: DataFrame, pos: DataFrame, as_of: str | None = None
) -> DataFrame:
    """Days of supply and status of each snapshot, from the demand of the last 28 days.

    Demand is folded to store and product before the join, which matches each snapshot
    to one row at most.
    """
    return availability_of(inventory, stores, products, recent_demand(pos, as_of))


def availability_of(inventory: DataFrame, stores: DataFrame, products: DataFrame, recent: DataFrame) -> DataFrame:
    """``on_shelf_availability`` with the demand as a table, one row per store and product."""
    rows = inventory.select("snapshot_date", "store_key", "upc", "on_hand_qty", "in_transit_qty")
    rows = rows.join(
        stores.select("store_key", "retailer_name", "region", "store_name", "store_id"), "store_key"
    )
    rows = add_product(rows, products, "upc", "brand", "category", "product_name", how="inner")
    demand, on_hand = F.col("avg_daily_units"), F.col("on_hand_qty")
    return (
        join_folded(rows, recent, ["store_key", "upc"])
        .withColumn("days_of_supply", ratio(on_hand, demand))
        .withColumn("days_of_supply_incl_transit", ratio(on_hand + F.col("in_transit_qty"), demand))
        .withColumn("availability_status", stock_status(on_hand, F.col("days_of_supply")))
        .select(
            "snapshot_date", "retailer_name", "region", "store_name", "store_id", "brand", "category",
            "product_name", "on_hand_qty", "in_transit_qty", "avg_daily_units", "days_of_supply",
            "days_of_supply_incl_transit", "availability_status",
        )
    )
