"""Gold tables kept up to date with what changed, instead of being built anew.

Sales reach these jobs as a ``Delta``: the rows that a merge brought in and the versions that they replaced (``sales_delta``).
Reference tables are given as they were and as they are. Two kinds of tables are kept:

* sums (daily sales, trailing demand) take signed sums of the changed rows; the fact is not read but for the days that leave a window;
* joined tables lose and gain the rows of affected keys, computed from the inputs cut down to these keys.

After each job a table equals the one built from all rows; ``tests/test_maintain.py`` holds them to that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.measures import ratio
from shelfline.operators.day_bits import day_bits, distinct_days, merged_bits
from shelfline.operators.deltas import Delta, merge_changes
from shelfline.operators.lookups import current_products, if_small, price_by_brand
from shelfline.operators.promo_days import running
from shelfline.operators.upsert import UpsertResult, _in_partitions
from shelfline.plans import gold, silver, staging
from shelfline.plans.build import plain_rows
from shelfline.sources.tables import overwrite, read_table, stored, table_exists, write_clustered

DEMAND_DAYS = 28


@dataclass(frozen=True)
class Versions:
    """A reference table as it was when the gold tables were made, and as it is."""

    old: DataFrame
    new: DataFrame

    def delta(self, keys: list[str]) -> Delta:
        return Delta.between(self.old, self.new, keys)


def same(table: DataFrame) -> Versions:
    return Versions(table, table)


def sales_delta(done: UpsertResult) -> Delta:
    """What a merge did to its fact; both frames hold until the next merge of that fact."""
    return Delta(plain_rows(done.increment), plain_rows(done.replaced))


def _either(rows: DataFrame, *keys: DataFrame) -> DataFrame:
    """Rows that meet any of some tables of distinct keys, each row once. A null part of a key counts like any other value."""
    met = rows
    for i, own in enumerate(keys):
        named = if_small(stored(own, "changed-keys")).withColumnsRenamed({c: f"_key_{c}" for c in own.columns}).withColumn(f"_met_{i}", F.lit(True))
        met = met.join(named, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in own.columns], "left").drop(*[f"_key_{c}" for c in own.columns])
    flags = [F.coalesce(f"_met_{i}", F.lit(False)) for i in range(len(keys))]
    wanted = flags[0]
    for flag in flags[1:]:
        wanted = wanted | flag
    return met.where(wanted).select(*rows.columns)


def _replace(spark: SparkSession, path: str, delta: Delta, partition_by: list[str], cluster_by: list[str], version: str | None) -> str:
    return merge_changes(spark, path, delta.net(), partition_by, cluster_by, version)


def _create(spark: SparkSession, path: str, rows: DataFrame, partition_by: list[str], cluster_by: list[str], version: str | None) -> str:
    """The table's first rows. Nothing can cancel out, so they are not counted."""
    inserts = rows.select(F.lit("INSERT").alias("change"), F.lit(1).cast("bigint").alias("copies"), *rows.columns)
    return merge_changes(spark, path, inserts, partition_by, cluster_by, version)


# --- conformed sales -----------------------------------------------------------------------


def refresh_conformed_sales(
    spark: SparkSession, path: str, orders: DataFrame, d_orders: Delta, products: Versions, fx: Versions, version: str | None = None
) -> str:
    """Conformed sales after orders came or went, product versions changed, or rates did; ``orders`` as they were.

    Orders are joined again if a version of their material changed, or the rate of their day and currency. The table lies in a folder
    a month of orders, ``order_month``.
    """

    def month(rows: DataFrame) -> DataFrame:
        return rows.withColumn("order_month", F.trunc("order_date", "month"))

    def master(version: DataFrame) -> DataFrame:
        return if_small(version.select(*gold.PRODUCT_OF_ORDER))

    master_new = master(products.new)
    if not table_exists(spark, path):
        every = Delta(orders.unionByName(d_orders.added), d_orders.removed).map(lambda rows: month(gold.conformed_sales(rows, master_new, fx.new)))
        return _replace(spark, path, every, ["order_month"], ["material_number"], version)
    materials = products.delta(["material_number", "effective_from"]).keys("material_number")
    rates = fx.delta(["rate_date", "currency_code"]).keys("rate_date", "currency_code")
    touched = stored(_either(orders, materials, rates.select(F.col("rate_date").alias("order_date"), F.col("currency_code").alias("currency"))), "touched-orders")
    new = Delta(touched.unionByName(d_orders.added), d_orders.removed).map(lambda rows: gold.conformed_sales(rows, master_new, fx.new))
    old = gold.conformed_sales(touched, master_new if products.old is products.new else master(products.old), fx.old)
    change = Delta(new.added, old.unionByName(new.removed)).map(month)
    return _replace(spark, path, change, ["order_month"], ["material_number"], version)


# --- promotions ----------------------------------------------------------------------------


def refresh_promotions(spark: SparkSession, path: str, raw: DataFrame, changes: DataFrame, products: Versions, version: str | None = None) -> str:
    """The promotion fact after a change set of the landed calendar, and after products changed; ``raw`` as it was.

    Both halves of an update go through staging and lookup like any row, so an edited promotion leaves as it was and comes as it is.
    """
    calendar = Delta.of(changes)
    if not table_exists(spark, path):
        raw, calendar = raw.limit(0), Delta(raw.unionByName(calendar.added), calendar.removed)
    materials = products.delta(["material_number", "effective_from"]).keys("material_number")
    touched = stored(_either(raw, materials), "touched-promotions")

    def fact(rows: DataFrame, master: DataFrame) -> DataFrame:
        found = silver.fct_promotions(staging.stage_promo(rows), master)
        return found.withColumn("start_month", F.trunc("start_date", "month"))

    change = Delta(
        fact(touched.unionByName(calendar.added), products.new),
        fact(touched, products.old).unionByName(fact(calendar.removed, products.new)),
    )
    return _replace(spark, path, change, ["start_month"], ["retailer_code"], version)


# --- daily sales and promotion lift --------------------------------------------------------

_DAY = ["upc", "retailer_code", "transaction_date"]
# What is added up by day. Counts of known values tell a sum of nothing from zero.
_MEASURES = {
    "units": "coalesce(units_sold, 0)",
    "day_rows": "cast(units_sold is not null as bigint)",
    "revenue": "coalesce(revenue_usd, 0)",
    "revenue_rows": "cast(revenue_usd is not null as bigint)",
    "all_rows": "1L",
}


def _known(total: str, rows: str):
    return F.when(F.col(rows) > 0, F.col(total))


def refresh_daily_sales(spark: SparkSession, path: str, sales: Delta, version: str | None = None) -> str:
    """Daily sums by product and retailer after sales changed: the sums of the days they lie on grow or shrink.

    The first call takes all sales as ``sales.added``. Only the months with changed days are read and rewritten.
    """
    grown = sales.sums(_DAY, **_MEASURES).withColumn("sale_month", F.trunc("transaction_date", "month"))
    sums = list(_MEASURES)
    if not table_exists(spark, path):
        return _create(spark, path, grown.where("all_rows > 0"), ["sale_month"], ["retailer_code", "upc"], version)
    grown = stored(grown, "daily-changes")
    keys = grown.select(*_DAY, "sale_month")
    months = [r[0] for r in keys.select("sale_month").distinct().collect()]
    known = [m for m in months if m is not None]
    in_months = F.col("sale_month").isin(known)
    old = read_table(spark, path, grown.schema).where(in_months | F.col("sale_month").isNull() if None in months else in_months)
    old = stored(_either(old, keys), "daily-before")
    new = old.unionByName(grown).groupBy(*_DAY, "sale_month").agg(*[F.sum(c).cast(grown.schema[c].dataType).alias(c) for c in sums])
    change = Delta(new.where("all_rows <> 0"), old)
    return _replace(spark, path, change, ["sale_month"], ["retailer_code", "upc"], version)


def daily_sales(spark: SparkSession, path: str) -> DataFrame:
    """The kept sums in the form that the lift analysis reads."""
    rows = read_table(spark, path)
    return rows.select(*_DAY, _known("units", "day_rows").alias("day_units"), "day_rows", _known("revenue", "revenue_rows").alias("day_revenue_usd"))


def refresh_promo_lift(
    spark: SparkSession, path: str, daily_path: str, sales: Delta, promos: Versions, products: Versions, version: str | None = None
) -> str:
    """Promotion lift after ``refresh_daily_sales`` took in ``sales``, and after promotions or products changed.

    A promotion is computed again if its product sold differently at its retailer, if it changed itself, if its product or the price of
    its brand did, or if the promotion days of its retailer did, which decide on baselines. Daily sums are read for these
    products and retailers only. The table lies in a folder a month of starts, ``start_month``.
    """
    daily = daily_sales(spark, daily_path)

    def month(rows: DataFrame) -> DataFrame:
        return rows.withColumn("start_month", F.trunc("start_date", "month"))

    if not table_exists(spark, path):
        rows = month(gold.promo_lift(promos.new, products.new, daily=daily))
        return _create(spark, path, rows, ["start_month"], ["retailer_code"], version)

    def described(version: DataFrame, master: DataFrame) -> DataFrame:
        own = current_products(master).select("material_number", F.col("upc").alias("_upc"), F.col("brand").alias("_brand"))
        return version.join(own, "material_number", "left").select("promo_id", F.col("_upc").alias("upc"), "retailer_code", "material_number", F.col("_brand").alias("brand"))

    sold = sales.keys("upc", "retailer_code")
    edited = promos.delta(["promo_id"])
    product_changes = Delta.between(current_products(products.old), current_products(products.new), ["material_number"])
    prices = Delta.between(price_by_brand(products.old), price_by_brand(products.new), ["brand"]).keys("brand")
    every = described(promos.old, products.old).unionByName(described(promos.new, products.new))
    # A promotion that came or went changes the baselines of all products of its retailer.
    affected = _either(every, sold, edited.keys("promo_id"), edited.keys("retailer_code"), product_changes.keys("material_number"), product_changes.keys("upc"), prices)
    affected = stored(affected.select("promo_id").distinct(), "affected-promotions")

    wanted = _either(promos.new, affected)
    own = current_products(products.new).select("material_number", F.col("upc").alias("_upc"))
    pairs = wanted.join(own, "material_number").select(F.col("_upc").alias("upc"), "retailer_code").distinct()
    of_pairs = stored(_either(daily, pairs), "daily-of-affected")
    # Windows and promotion days come from all promotions; windows are cut to the days of all sales.
    calendar = running(promos.new, daily)
    new = month(gold.lift_of(running(wanted, daily), calendar, products.new, of_pairs))
    old = _either(read_table(spark, path), affected)
    change = Delta(new, old.select(*new.columns))
    return _replace(spark, path, change, ["start_month"], ["retailer_code"], version)


# --- selling days --------------------------------------------------------------------------


def refresh_selling_days(spark: SparkSession, path: str, sales: Delta) -> None:
    """Bits of the days on which each store sold each product, after ``sales`` came in. Only the months with new days are rewritten.

    Store, product and day follow from the key of a sale, so a replaced version leaves the same bit behind.
    """
    bits = day_bits(sales.added, _SERIES, "transaction_date", "sale_month")
    if not table_exists(spark, path):
        write_clustered(bits, path, "sale_month", _SERIES)
        return
    bits = stored(bits, "new-days")
    held = read_table(spark, path, bits.schema).where(_in_partitions(bits, "sale_month"))
    both = stored(merged_bits([held, bits], _SERIES, "sale_month"), "merged-days")
    write_clustered(both, path, "sale_month", _SERIES, only_touched=True)


def selling_days(spark: SparkSession, path: str, products: DataFrame) -> DataFrame:
    """Distinct selling days by store and brand; products count for the brand they have now."""
    brands = if_small(current_products(products).select("upc", "brand"))
    return distinct_days(read_table(spark, path).join(brands, "upc", "left"), ["store_key", "brand"], "sale_month")


# --- trailing demand and availability ------------------------------------------------------

_SERIES = ["store_key", "upc"]
_DEMAND = {n: _MEASURES[n] for n in ("units", "day_rows", "all_rows")}


def refresh_demand(spark: SparkSession, path: str, pos: DataFrame, sales: Delta | None, as_of: str, days: int = DEMAND_DAYS) -> None:
    """Sums of units of the last ``days`` by store and product, moved on to ``as_of``.

    ``pos`` are the sales as they are now, of which only the days that have left the window are read: what ``sales`` changed within
    the window before is added, and then these days are taken off. The first call, with ``sales`` None, adds up the window. Each
    ``as_of`` has a folder of its own, so a run that died is repeated; a call for the newest one or an earlier one fails.
    """
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    known = demand_days(spark, path)
    if not known or sales is None:
        window = Delta(pos.where(F.col("transaction_date") >= start), pos.limit(0))
        sums = window.sums(_SERIES, **_DEMAND)
    else:
        if max(known) >= as_of:
            raise ValueError(f"demand is known as of {max(known)}")
        before = F.date_sub(F.lit(max(known)).cast("date"), days)
        held = read_table(spark, f"{path}/as_of={max(known)}")
        inside = sales.map(lambda rows: rows.where(F.col("transaction_date") >= before))
        gone = Delta(pos.limit(0), pos.where((F.col("transaction_date") >= before) & (F.col("transaction_date") < start)))
        parts = [held, inside.sums(_SERIES, **_DEMAND), gone.sums(_SERIES, **_DEMAND)]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        sums = rows.groupBy(*_SERIES).agg(*[F.sum(c).alias(c) for c in _DEMAND])
    sums = sums.where("all_rows <> 0").select(*_SERIES, F.col("units").cast("decimal(38,0)").alias("units"), "day_rows", "all_rows")
    overwrite(sums, f"{path}/as_of={as_of}")


def demand_days(spark: SparkSession, path: str) -> list[str]:
    """The days as of which the demand is kept."""
    if not table_exists(spark, path):
        return []
    return [str(r[0]) for r in spark.read.parquet(path).select("as_of").distinct().collect()]


def demand(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    """Mean units per sales row, as ``gold.recent_demand`` has it."""
    mean_units = ratio(F.col("units"), F.col("day_rows"))
    return read_table(spark, f"{path}/as_of={as_of}").select(*_SERIES, mean_units.alias("avg_daily_units"))


def refresh_availability(
    spark: SparkSession, path: str, inventory: DataFrame, d_inventory: Delta, stores: Versions, products: Versions, demand: Versions, version: str | None = None
) -> str:
    """On-shelf availability after snapshots, stores, products or the demand changed; ``inventory`` as it was.

    Snapshots are computed again if their store or product changed or the demand of their series did; all others stay. The table
    lies in a folder a month of snapshots, ``snapshot_month``.
    """

    def rows(stock: DataFrame, new: bool) -> DataFrame:
        own = [v.new if new else v.old for v in (stores, products, demand)]
        return gold.availability_of(stock, *own).withColumn("snapshot_month", F.trunc("snapshot_date", "month"))

    if not table_exists(spark, path):
        change = Delta(rows(inventory.unionByName(d_inventory.added), True), rows(d_inventory.removed, True))
        return _replace(spark, path, change, ["snapshot_month"], ["retailer_name", "store_id"], version)
    used = Versions(*(current_products(p).select("upc", "brand", "category", "product_name") for p in (products.old, products.new)))
    touched = _either(
        inventory, stores.delta(["store_key"]).keys("store_key"), used.delta(["upc"]).keys("upc"), demand.delta(_SERIES).keys(*_SERIES)
    )
    touched = stored(touched, "touched-stock")
    change = Delta(
        rows(touched.unionByName(d_inventory.added), True), rows(touched, False).unionByName(rows(d_inventory.removed, True))
    )
    return _replace(spark, path, change, ["snapshot_month"], ["retailer_name", "store_id"], version)
