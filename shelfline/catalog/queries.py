"""Every operator as a named query over one data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, FractionalType, IntegralType, TimestampNTZType, TimestampType

from shelfline import schemas
from shelfline.catalog.tables import AS_OF, AUDIT_AT, FIRST_LOAD_END, RUN_TIME, Tables
from shelfline.functions import keys, measures, parsing
from shelfline.operators import changes, deltas, layouts, lookups, promo_days, quality, upsert, versions
from shelfline.operators.deltas import Delta
from shelfline.plans import bronze, build, features, gold, maintain, refresh, silver, staging
from shelfline.session import shared_dir
from shelfline.sources import raw, tables
from shelfline.streaming import ingest

Query = Callable[[Tables], DataFrame]
REGISTRY: dict[str, Query] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def query(*ids: str) -> Callable[[Query], Query]:
    """Registers a function under its own name, with the survey ids it covers."""

    def add(fn: Query) -> Query:
        REGISTRY[fn.__name__] = fn
        COVERS[fn.__name__] = ids
        return fn

    return add


def portable(df: DataFrame) -> DataFrame:
    """Numbers as double or bigint, dates and times as text, flags as 0/1.

    Clients of different engines hand back decimals, dates and nullable flags in
    different shapes; these types compare alike everywhere.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType) or isinstance(f.dataType, FractionalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (IntegralType, BooleanType)):
            c = c.cast("bigint") if isinstance(f.dataType, IntegralType) else c.cast("int").cast("bigint")
        elif isinstance(f.dataType, (DateType, TimestampNTZType, TimestampType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(REGISTRY[name](Tables(spark, sf_dir)))


def _new_dir(t: Tables, name: str) -> str:
    return shared_dir(t.spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


def _month(df: DataFrame, date: str, name: str = "sale_month") -> DataFrame:
    return df.withColumn(name, F.trunc(date, "month"))


# --- sources and sinks -------------------------------------------------------------


def _landed(t: Tables, feed: str, fmt: str, df: DataFrame | None = None, **options: str) -> str:
    path = _new_dir(t, feed)
    (getattr(t, feed) if df is None else df).write.format(fmt).options(**options).save(path)
    return path


@query("S1", "S6")
def raw_orders(t: Tables) -> DataFrame:
    path = _landed(t, "raw_orders", "csv", t.raw_orders.drop(*schemas.LINEAGE), nullValue="\\N")
    df = raw.read_files(t.spark, "raw_orders", path, "csv", loaded_at=RUN_TIME, nullValue="\\N")
    return df.withColumn("_file_name", F.regexp_extract("_file_name", r"\.(\w+)$", 1))


@query("S2")
def raw_pos(t: Tables) -> DataFrame:
    # As plain text the feed takes over ten times the disk of the tables it comes from. A packed file is read by one task, so files are kept small.
    path = _landed(t, "raw_pos", "json", compression="gzip", maxRecordsPerFile="1000000")
    return raw.read_feed(t.spark, "raw_pos", path, "json")


@query("S3")
def raw_inventory(t: Tables) -> DataFrame:
    return raw.read_feed(t.spark, "raw_inventory", _landed(t, "raw_inventory", "parquet"))


@query("S4")
def raw_promo(t: Tables) -> DataFrame:
    return raw.read_feed(t.spark, "raw_promo", _landed(t, "raw_promo", "orc"), "orc")


def _reference(t: Tables, name: str, schema) -> DataFrame:
    path = _new_dir(t, name)
    tables.overwrite(getattr(t, name), path, schema)
    return tables.read_table(t.spark, path, schema)


@query("S5")
def dim_product(t: Tables) -> DataFrame:
    return _reference(t, "dim_product", schemas.DIM_PRODUCT)


@query("S5")
def dim_store(t: Tables) -> DataFrame:
    return _reference(t, "dim_store", schemas.DIM_STORE)


@query("S5")
def dim_fx(t: Tables) -> DataFrame:
    return _reference(t, "dim_fx", schemas.DIM_FX)


@query("S6")
def file_lineage(t: Tables) -> DataFrame:
    scan = raw.with_lineage(t.spark.read.parquet(f"{t.sf_dir}/lineitem.parquet").select("l_orderkey"), RUN_TIME)
    table = F.regexp_extract("_file_name", r"([^/]+)\.parquet", 1)
    return scan.groupBy(table.alias("source_table"), "_loaded_at").agg(F.count("*").alias("rows"))


@query("S8", "I1")
def append_orders(t: Tables) -> DataFrame:
    path, mark = _new_dir(t, "orders_staged"), F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    tables.append(t.orders_staged.where(F.col("_loaded_at") <= mark), path, schemas.ORDERS_STAGED)
    tables.append(t.orders_staged.where(F.col("_loaded_at") > mark), path, schemas.ORDERS_STAGED)
    return tables.read_table(t.spark, path)


@query("S9", "A11", "B6")
def overwrite_enriched_pos(t: Tables) -> DataFrame:
    path = _new_dir(t, "pos_enriched")
    tables.overwrite(t.pos_enriched.where("promo_flag = 'Y'"), path)
    rows = tables.overwrite(t.pos_enriched, path)
    return (
        tables.read_table(t.spark, path)
        .groupBy("brand")
        .agg(F.count("*").alias("rows"), F.sum("units_sold").alias("units"), F.sum("kg_sold").alias("kg"))
        .withColumn("rows_written", F.lit(rows))
    )


@query("S10", "C6")
def rebuild_promotions(t: Tables) -> DataFrame:
    path = _new_dir(t, "fct_promotions")
    refresh.rebuild(lambda: t.fct_promotions.where("upc IS NULL"), path)
    refresh.rebuild(lambda: t.fct_promotions, path)
    return tables.read_table(t.spark, path)


@query("S11")
def clustered_pos_sales(t: Tables) -> DataFrame:
    path = _new_dir(t, "fct_pos_sales")
    tables.write_clustered(
        _month(t.fct_pos_sales, "transaction_date"), path, "sale_month", ["transaction_date", "retailer_code"]
    )
    return (
        tables.read_table(t.spark, path)
        .groupBy("sale_month", "retailer_code")
        .agg(F.count("*").alias("rows"), F.sum("units_sold").alias("units"), F.sum("kg_sold").alias("kg"))
    )


@query("S11", "M4")
def sorted_products(t: Tables) -> DataFrame:
    root = _new_dir(t, "built")
    build.build_product_versions(t.dim_product, root, RUN_TIME)
    return tables.read_table(t.spark, build.silver_path(root, "dim_product_versions"))


@query("S9", "A11", "M5")
def built_features(t: Tables) -> DataFrame:
    root = _new_dir(t, "built")
    rows = build.build_features(t.pos_cleansed, root)
    return (
        tables.read_table(t.spark, build.silver_path(root, "demand_features"))
        .groupBy("store_key")
        .agg(F.count("*").alias("rows"), F.sum("daily_units").alias("units"))
        .withColumn("rows_written", F.lit(rows))
    )


@query("S12")
def named_tables(t: Tables) -> DataFrame:
    raw.register_views(t.spark, {"sales_fact": t.fct_pos_sales, "store_list": t.dim_store})
    stores = t.spark.table("store_list").select("store_key", "region")
    sales = t.spark.sql(
        "SELECT store_key, brand, sum(units_sold) AS units FROM sales_fact GROUP BY store_key, brand"
    )
    return sales.join(stores, "store_key").groupBy("region", "brand").agg(F.sum("units").alias("units"))


@query("S13", "A7")
def staging_views(t: Tables) -> DataFrame:
    views = {"stg_pos": t.stg_pos, "stg_inventory": t.stg_inventory, "stg_promo": t.stg_promo}
    raw.register_views(t.spark, {f"view_{n}": df for n, df in views.items()})
    return t.spark.sql(
        """SELECT 'stg_pos' AS view_name, count(*) AS rows, max(loaded_at) AS newest FROM view_stg_pos
        UNION ALL SELECT 'stg_inventory', count(*), max(loaded_at) FROM view_stg_inventory
        UNION ALL SELECT 'stg_promo', count(*), max(loaded_at) FROM view_stg_promo"""
    )


# --- parsing -----------------------------------------------------------------------


@query("P1")
def order_dates(t: Tables) -> DataFrame:
    parsed = parsing.parse_date(F.col("order_date"), parsing.COMPACT)
    return t.raw_orders.groupBy(parsed.alias("order_date")).agg(F.count("*").alias("rows"))


@query("P2")
def snapshot_dates(t: Tables) -> DataFrame:
    parsed = parsing.parse_date_auto(F.col("snapshot_date"))
    return t.raw_inventory.groupBy(parsed.alias("snapshot_date")).agg(F.count("*").alias("rows"))


@query("P3")
def sale_dates(t: Tables) -> DataFrame:
    parsed = parsing.parse_date_by_source(F.col("retailer_code"), F.col("transaction_date"))
    return t.raw_pos.groupBy("retailer_code", parsed.alias("sale_date")).agg(F.count("*").alias("rows"))


@query("P4", "P5")
def parsed_numbers(t: Tables) -> DataFrame:
    units = parsing.parse_integer(F.col("units_sold"))
    revenue = parsing.parse_decimal(F.col("revenue"), 18, 2)
    return t.raw_pos.groupBy("store_id").agg(
        F.sum(units).alias("units"),
        F.sum(revenue).alias("revenue"),
        F.count_if(units.isNull()).alias("bad_units"),
        F.count_if(revenue.isNull()).alias("bad_revenue"),
    )


@query("P6", "F4")
def strict_sales(t: Tables) -> DataFrame:
    return bronze.strict_pos(t.readable_pos).groupBy("retailer_code", "sale_date").agg(
        F.count("*").alias("rows"), F.sum("units_sold").alias("units")
    )


@query("P7", "P8", "A6")
def promo_flags(t: Tables) -> DataFrame:
    flag = parsing.yes_flag(F.col("promo_flag"))
    return t.raw_pos.groupBy("store_id", flag.alias("is_promo")).agg(
        F.count("*").alias("rows"), F.max(parsing.flag_number(flag)).alias("had_promo")
    )


@query("P9", "P10")
def tidy_codes(t: Tables) -> DataFrame:
    return t.raw_pos.groupBy(
        parsing.tidy_code(F.col("retailer_code")).alias("retailer_code"),
        F.length(parsing.digits(F.col("upc"))).alias("upc_digits"),
    ).agg(F.count("*").alias("rows"), F.min(parsing.digits(F.col("upc"))).alias("first_upc"))


@query("P11", "P12", "A1")
def unit_prices(t: Tables) -> DataFrame:
    totals = (
        t.stg_pos.withColumns({"amount": F.col("revenue"), "pieces": F.col("units_sold")})
        .drop("revenue", "units_sold")
        .groupBy("store_id", "upc")
        .agg(F.sum("amount").alias("amount"), F.sum("pieces").alias("pieces"))
    )
    return totals.withColumn("unit_price", measures.ratio(F.col("amount"), F.col("pieces"))).withColumn(
        "is_cheap", F.col("unit_price") < 1000
    )


@query("X1")
def check_digits(t: Tables) -> DataFrame:
    return t.raw_pos.groupBy("store_id").agg(
        F.count_if(parsing.check_digit_ok(F.col("upc"))).alias("passing"), F.count("*").alias("rows")
    )


# --- filters -----------------------------------------------------------------------


@query("P5", "F3", "B3")
def rejected_sales(t: Tables) -> DataFrame:
    return bronze.rejected_pos(t.raw_pos, RUN_TIME)


@query("P5", "F5", "B4")
def rejected_stock(t: Tables) -> DataFrame:
    return bronze.rejected_inventory(t.raw_inventory, RUN_TIME)


@query("P6", "F4", "B6")
def unreadable_sales(t: Tables) -> DataFrame:
    return bronze.unreadable_pos(t.raw_pos, RUN_TIME)


@query("F1", "F2", "F3", "F5", "A7")
def feed_counts(t: Tables) -> DataFrame:
    """Rows landed, accepted and rejected; the last two add up to the first."""
    feeds = {
        "orders": (t.raw_orders, t.orders_staged, bronze.quarantine_orders(t.raw_orders, RUN_TIME)),
        "sales": (t.raw_pos, t.stg_pos, bronze.rejected_pos(t.raw_pos)),
        "stock": (t.raw_inventory, t.stg_inventory, bronze.rejected_inventory(t.raw_inventory)),
        "readable sales": (t.raw_pos, t.readable_pos, bronze.unreadable_pos(t.raw_pos)),
    }
    counted = [
        df.agg(F.lit(feed).alias("feed"), F.lit(kind).alias("kind"), F.count("*").alias("n"))
        for feed, frames in feeds.items()
        for kind, df in zip(("landed", "accepted", "rejected"), frames, strict=True)
    ]
    kinds = ["landed", "accepted", "rejected"]
    return reduce(DataFrame.unionByName, counted).groupBy("feed").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in kinds]
    )


@query("F1", "F2", "F9", "A10")
def order_counts(t: Tables) -> DataFrame:
    return bronze.order_counts(t.raw_orders)


@query("F3")
def upc_and_units(t: Tables) -> DataFrame:
    kept = parsing.upc_has_length(F.col("upc"), 12, 13) & (parsing.parse_integer(F.col("units_sold")) >= 0)
    return t.raw_pos.where(kept).groupBy("upc").agg(F.count("*").alias("rows"))


@query("F5")
def stock_counts(t: Tables) -> DataFrame:
    return t.stg_inventory.groupBy("snapshot_date").agg(
        F.count("*").alias("rows"), F.sum("on_hand_qty").alias("on_hand")
    )


@query("F6")
def current_products(t: Tables) -> DataFrame:
    return lookups.current_products(t.dim_product)


@query("F8", "F9", "A5")
def recent_demand(t: Tables) -> DataFrame:
    return gold.recent_demand(t.fct_pos_sales, AS_OF)


# --- joins -------------------------------------------------------------------------


@query("J1")
def store_lookup(t: Tables) -> DataFrame:
    return (
        lookups.add_store_key(t.stg_pos, t.dim_store)
        .groupBy("retailer_code", "store_id", "store_key")
        .agg(F.count("*").alias("rows"))
    )


@query("J2")
def product_lookup(t: Tables) -> DataFrame:
    return (
        lookups.add_product(t.stg_pos, t.dim_product, "upc", "brand", "category")
        .groupBy("upc", "brand", "category")
        .agg(F.count("*").alias("rows"))
    )


@query("J3")
def promo_products(t: Tables) -> DataFrame:
    return lookups.add_product(t.stg_promo, t.dim_product, "material_number", "upc").select(
        "promo_id", "material_number", "upc"
    )


@query("J4")
def monthly_rates(t: Tables) -> DataFrame:
    return gold.rows_without_rate(t.stg_pos, t.dim_fx, "transaction_date", "currency_code", monthly=True)


@query("J5")
def daily_rates(t: Tables) -> DataFrame:
    return gold.rows_without_rate(t.orders_staged, t.dim_fx, "order_date", "currency", monthly=False)


@query("J6", "F7")
def product_as_of(t: Tables) -> DataFrame:
    return (
        lookups.add_product_as_of(t.orders_staged, t.dim_product, "order_date", "unit_weight_kg")
        .groupBy("material_number", "product_unit_weight_kg")
        .agg(F.count("*").alias("rows"), F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    )


@query("J7")
def sales_by_place(t: Tables) -> DataFrame:
    rows = t.fct_pos_sales.join(t.dim_store.select("store_key", "region"), "store_key")
    rows = lookups.add_product(rows, t.dim_product, "upc", "sub_category", how="inner")
    return rows.groupBy("region", "sub_category").agg(
        F.count("*").alias("rows"), F.sum("units_sold").alias("units")
    )


def _promo_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    daily = tables.stored(promo_days.daily_sales(t.fct_pos_sales), "daily_sales")
    return daily, promo_days.running(t.fct_promotions, daily)


@query("J8", "F7")
def promo_sales(t: Tables) -> DataFrame:
    return gold.promo_sales(*_promo_inputs(t), t.dim_product)


@query("J9", "A5")
def baseline_sales(t: Tables) -> DataFrame:
    return gold.baseline_sales(*_promo_inputs(t), t.dim_product)


@query("J9")
def promo_calendar_days(t: Tables) -> DataFrame:
    return promo_days.covered_days(t.fct_promotions)


@query("J11")
def stock_and_demand(t: Tables) -> DataFrame:
    known = t.fct_inventory.where(F.col("store_key").isNotNull() & F.col("upc").isNotNull())
    return lookups.join_folded(known, gold.recent_demand(t.fct_pos_sales, AS_OF), ["store_key", "upc"]).select(
        "store_key", "upc", "snapshot_date", "on_hand_qty", "avg_daily_units"
    )


@query("J12")
def orphan_upcs(t: Tables) -> DataFrame:
    return lookups.orphans(t.stg_pos, t.dim_product, "upc", "upc")


@query("J13", "L2")
def brand_prices(t: Tables) -> DataFrame:
    return lookups.price_by_brand(t.dim_product)


@query("J14", "A8", "I1")
def rows_after_mark(t: Tables) -> DataFrame:
    target = t.fct_pos_sales.where(F.col("_loaded_at") <= F.lit(FIRST_LOAD_END).cast("timestamp_ntz"))
    return (
        upsert.newer_than(t.stg_pos, target, "loaded_at", "_loaded_at")
        .groupBy("loaded_at")
        .agg(F.count("*").alias("rows"))
    )


# --- aggregates and windows ----------------------------------------------------------


@query("A2", "A3", "A6", "S12")
def daily_store_sales(t: Tables) -> DataFrame:
    return features.daily_store_sales(t.pos_cleansed)


@query("A4")
def selling_days(t: Tables) -> DataFrame:
    return t.fct_pos_sales.groupBy("store_key", "brand").agg(
        F.count_distinct("transaction_date").alias("selling_days"), F.sum("units_sold").alias("units")
    )


@query("A9")
def repeated_keys(t: Tables) -> DataFrame:
    return quality.duplicates(t.fct_pos_sales, "pos_sale_sk")


@query("W1", "W2", "W3", "W4", "W5", "P11", "M5")
def demand_features(t: Tables) -> DataFrame:
    return t.demand_features


@query("W1", "W5")
def demand_features_iso_week(t: Tables) -> DataFrame:
    return features.demand_features(t.pos_cleansed, week_start=1).select(
        "store_key", "upc", "transaction_date", "day_of_week", "month_num", "is_weekend"
    )


@query("W1", "W2", "W3", "W4", "W5")
def demand_features_by_calendar(t: Tables) -> DataFrame:
    return features.demand_features_by_calendar(t.pos_cleansed)


@query("X2")
def days_since_stockout(t: Tables) -> DataFrame:
    return features.demand_features_with_stockouts(t.pos_cleansed, t.inventory_cleansed)


@query("L1", "B6")
def latest_sales(t: Tables) -> DataFrame:
    return bronze.latest_sales(t.pos_enriched)


@query("F8")
def calendar_functions(t: Tables) -> DataFrame:
    d = F.col("order_date")
    return t.orders_staged.select(d).distinct().select(
        d,
        F.trunc(d, "week").alias("week_start"),
        F.trunc(d, "month").alias("month_start"),
        F.date_sub(d, 28).alias("four_weeks_before"),
        measures.whole_days(F.trunc(d, "month"), d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.month(d).alias("month_num"),
        (d.cast("timestamp_ntz") - F.expr("interval 1 hour")).alias("hour_before"),
    )


# --- jobs ----------------------------------------------------------------------------


@query("B1", "F1", "P1", "P4")
def stage_orders(t: Tables) -> DataFrame:
    return t.orders_staged


@query("B2", "F2")
def quarantine_orders(t: Tables) -> DataFrame:
    return bronze.quarantine_orders(t.raw_orders, RUN_TIME)


@query("B3")
def cleanse_pos(t: Tables) -> DataFrame:
    return t.pos_cleansed


@query("B4")
def cleanse_inventory(t: Tables) -> DataFrame:
    return t.inventory_cleansed


@query("B5", "F8", "A7")
def pos_quality_audit(t: Tables) -> DataFrame:
    return bronze.pos_quality_audit(t.pos_cleansed, AUDIT_AT)


@query("B5")
def pos_quality_audit_all(t: Tables) -> DataFrame:
    return bronze.pos_quality_audit(t.pos_cleansed, "2000-01-01 00:00:00", hours=24 * 365 * 10)


@query("B6")
def enrich_pos(t: Tables) -> DataFrame:
    return t.pos_enriched


@query("V1")
def stg_pos(t: Tables) -> DataFrame:
    return t.stg_pos


@query("V2")
def stg_inventory(t: Tables) -> DataFrame:
    return t.stg_inventory


@query("V3")
def stg_promo(t: Tables) -> DataFrame:
    return t.stg_promo


@query("M1", "K1b")
def fct_pos_sales(t: Tables) -> DataFrame:
    return t.fct_pos_sales


@query("M1", "K1b")
def fct_pos_sales_by_store_id(t: Tables) -> DataFrame:
    df = silver.fct_pos_sales(t.stg_pos, t.dim_store, t.dim_product, t.dim_fx, key_store="store_id")
    return df.select("pos_sale_sk", "store_key", "upc", "transaction_date", "units_sold")


@query("M1", "K1a")
def fct_pos_sales_from_bronze(t: Tables) -> DataFrame:
    return silver.fct_pos_sales_from_bronze(t.pos_cleansed, t.dim_product)


@query("M2", "K1b")
def fct_inventory(t: Tables) -> DataFrame:
    return t.fct_inventory


@query("M2", "K1a")
def fct_inventory_from_bronze(t: Tables) -> DataFrame:
    return silver.fct_inventory_from_bronze(t.inventory_cleansed)


@query("M3")
def fct_promotions(t: Tables) -> DataFrame:
    return t.fct_promotions


@query("M3")
def fct_promotions_loaded(t: Tables) -> DataFrame:
    return silver.fct_promotions_loaded(t.stg_promo, t.dim_product, RUN_TIME)


@query("M4", "K2")
def dim_product_versions(t: Tables) -> DataFrame:
    return silver.dim_product_versions(t.dim_product, RUN_TIME)


@query("K2")
def numbered_orders(t: Tables) -> DataFrame:
    lines = t.raw_orders.select("record_id", "plant", F.coalesce("order_qty", F.lit("")).alias("order_qty"))
    return keys.number_rows(lines, "order_sk", ["record_id"], start=1000)


@query("K2")
def hashed_products(t: Tables) -> DataFrame:
    numbered = t.dim_product.select(
        keys.hash_number("material_number", "effective_from").alias("product_sk"), "material_number"
    )
    return numbered.groupBy("material_number").agg(F.count_distinct("product_sk").alias("versions"))


@query("M4", "K2")
def lasting_product_numbers(t: Tables) -> DataFrame:
    """The dimension built before a category was sold, and again with it: versions keep the numbers they had."""
    root = _new_dir(t, "built")
    for products in (_products_before(t), t.dim_product, t.dim_product):
        build.build_product_versions(products, root, RUN_TIME)
    return tables.read_table(t.spark, build.silver_path(root, "dim_product_versions"))


@query("G1")
def conformed_sales(t: Tables) -> DataFrame:
    return t.conformed_sales


@query("G2")
def weekly_store_demand(t: Tables) -> DataFrame:
    return t.weekly_store_demand


@query("G3", "J8", "J9", "J13")
def promo_lift(t: Tables) -> DataFrame:
    return gold.promo_lift(t.fct_promotions, t.dim_product, t.fct_pos_sales)


@query("G3", "J10")
def promo_lift_by_retailer(t: Tables) -> DataFrame:
    return gold.promo_lift_by_retailer(t.fct_promotions, t.dim_product, t.fct_pos_sales)


@query("G4", "J11", "X4")
def on_shelf_availability(t: Tables) -> DataFrame:
    return gold.on_shelf_availability(
        t.fct_inventory, t.dim_store, t.dim_product, t.fct_pos_sales, AS_OF
    )


# --- incremental upkeep ----------------------------------------------------------------


def _reference_tables(t: Tables) -> dict[str, DataFrame]:
    return {n: getattr(t, n) for n in ("dim_store", "dim_product", "dim_fx")}


def _loads(t: Tables, feed: str = "raw_pos") -> list[DataFrame]:
    """The feed as it stood at the end of the first load, and as it stands now."""
    landed = getattr(t, feed)
    return [landed.where(F.col("_loaded_at") <= F.lit(FIRST_LOAD_END).cast("timestamp_ntz")), landed]


def _merge_sales(t: Tables, root: str, landed: DataFrame, full: bool = False) -> upsert.UpsertResult:
    """One run over what has landed. Months, as there are few rows a day."""

    def make(rows: DataFrame) -> DataFrame:
        return silver.fct_pos_sales(staging.stage_pos(rows), t.dim_store, t.dim_product, t.dim_fx)

    return build.merge_fact(t.spark, root, "fct_pos_sales", landed, make, by="month", full=full)


@query("I1", "I2", "J14")
def incremental_pos_sales(t: Tables) -> DataFrame:
    root = _new_dir(t, "incremental")
    for landed in _loads(t):
        _merge_sales(t, root, landed)
    return build.read_fact(t.spark, root, "fct_pos_sales")


@query("I3")
def full_refresh_pos_sales(t: Tables) -> DataFrame:
    root = _new_dir(t, "incremental")
    for landed in _loads(t):
        _merge_sales(t, root, landed, full=True)
    return build.read_fact(t.spark, root, "fct_pos_sales")


@query("I2", "M1", "K1a")
def incremental_from_bronze(t: Tables) -> DataFrame:
    """Keys here are null for unknown stores or dates; such rows are counted, not merged."""
    root = _new_dir(t, "incremental")
    for landed in _loads(t):
        build.merge_fact(
            t.spark, root, "fct_pos_sales", landed,
            lambda rows: silver.fct_pos_sales_from_bronze(bronze.cleanse_pos(rows, t.dim_store, t.dim_fx), t.dim_product),
            by="month",
        )
    return build.read_fact(t.spark, root, "fct_pos_sales")


@query("I1", "J14")
def late_sales(t: Tables) -> DataFrame:
    """Some sales of the last month before the first load land after it; a lookback picks them up."""
    root, end = _new_dir(t, "incremental"), F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    late = F.coalesce(F.col("store_id").endswith("3"), F.lit(False)) & (F.col("_loaded_at") > end - F.expr("interval 30 days"))
    for landed in (t.raw_pos.where((F.col("_loaded_at") <= end) & ~late), t.raw_pos):
        feeds = {"raw_pos": landed, "raw_inventory": t.raw_inventory.limit(0), "raw_promo": t.raw_promo.limit(0)}
        build.build_silver(t.spark, feeds, _reference_tables(t), root, by="month", stop=False, lookback="40 days")
    return build.read_fact(t.spark, root, "fct_pos_sales")


@query("I2", "K1a")
def keyless_sales(t: Tables) -> DataFrame:
    """The rows that the merge of the bronze sales leaves out: all without a key."""
    rows = silver.fct_pos_sales_from_bronze(t.pos_cleansed, t.dim_product)
    return upsert.upsert(t.spark, _new_dir(t, "keyless"), rows, "pos_sale_sk", "retailer_code").rejects


@query("M1", "M2", "M5", "I2")
def sales_from_bronze_build(t: Tables) -> DataFrame:
    """The build from bronze to silver; the sales fact it makes."""
    root = _new_dir(t, "built")
    build.build_silver_from_bronze(t.spark, t.pos_cleansed, t.inventory_cleansed, t.dim_product, root, by="month")
    return build.read_fact(t.spark, root, "fct_pos_sales")


def _merge_inventory(t: Tables, root: str, landed: DataFrame) -> upsert.UpsertResult:
    def make(rows: DataFrame) -> DataFrame:
        return silver.fct_inventory(staging.stage_inventory(rows), t.dim_store)

    return build.merge_fact(t.spark, root, "fct_inventory", landed, make, by="month")


@query("I2", "M2")
def incremental_inventory(t: Tables) -> DataFrame:
    root = _new_dir(t, "incremental")
    for landed in _loads(t, "raw_inventory"):
        _merge_inventory(t, root, landed)
    return build.read_fact(t.spark, root, "fct_inventory")


def _dotted(text: str):
    """A third date layout: ISO texts with the day first and dots between."""
    return F.regexp_replace(text, r"^(\d{4})-(\d{2})-(\d{2})$", "$3.$2.$1")


def _dotted_sales(t: Tables) -> DataFrame:
    return t.raw_pos.withColumn("transaction_date", F.when(F.col("retailer_code").startswith("R"), _dotted("transaction_date")).otherwise(F.col("transaction_date")))


@query("P2", "P3", "S13")
def sales_with_layouts(t: Tables) -> DataFrame:
    """The silver build over feeds in a third date layout, which the build is told."""
    root = _new_dir(t, "built")
    stock = t.raw_inventory.withColumn("snapshot_date", _dotted("snapshot_date"))
    told = staging.Layouts(sales_default=(*parsing.AUTO_DATES, layouts.DOTTED), snapshots=(*parsing.AUTO_DATES, layouts.DOTTED))
    feeds = {"raw_pos": _dotted_sales(t), "raw_inventory": stock, "raw_promo": t.raw_promo}
    build.build_silver(t.spark, feeds, _reference_tables(t), root, by="month", stop=False, layouts=told)
    sales, snapshots = (build.read_fact(t.spark, root, n) for n in build.FACTS)
    return sales.select("pos_sale_sk", "transaction_date", "units_sold").unionByName(
        snapshots.select(F.col("inventory_sk").alias("pos_sale_sk"), F.col("snapshot_date").alias("transaction_date"), F.col("on_hand_qty").alias("units_sold"))
    )


@query("P2", "P3")
def found_layouts(t: Tables) -> DataFrame:
    """The date layout of each retailer's sales, found in their texts."""
    return layouts.find_layouts(_dotted_sales(t), "transaction_date")


@query("P2", "P3", "B3")
def sales_of_found_layouts(t: Tables) -> DataFrame:
    """Sales dated by the layouts that were found."""
    landed = _dotted_sales(t)
    found = tables.stored(layouts.find_layouts(landed, "transaction_date"), "layouts")
    cleansed = bronze.cleanse_pos(landed, t.dim_store, t.dim_fx, staging.Layouts(sales=found))
    return cleansed.groupBy("retailer_code", "transaction_date").agg(F.count("*").alias("rows"), F.sum("units_sold").alias("units"))


@query("S8", "Q-N")
def stores_lacking_required(t: Tables) -> DataFrame:
    """Rows that a table can't take, since a column declared as never null is null."""
    key = F.col("store_key")
    damaged = t.dim_store.withColumns({"store_id": F.when(key % 7 != 0, F.col("store_id")), "retailer_code": F.when(key % 5 != 0, F.col("retailer_code"))})
    return tables.lacking_required(damaged, schemas.DIM_STORE).select("store_key", "store_name", "missing")


def _built(t: Tables) -> tuple[str, DataFrame]:
    root = _new_dir(t, "built")
    feeds = {n: getattr(t, n) for n in ("raw_pos", "raw_inventory", "raw_promo")}
    return root, build.build_silver(t.spark, feeds, _reference_tables(t), root, by="month", stop=False)


@query("C5", "S13", "Q-S", "I3")
def build_report(t: Tables) -> DataFrame:
    """Staging, silver and then the checks, in order."""
    return _built(t)[1]


@query("C5", "C6", "G1", "G2", "G3", "G4")
def build_counts(t: Tables) -> DataFrame:
    """Silver, then all gold tables: their row counts and a total of each."""
    root, _ = _built(t)
    rows = build.build_gold(t.spark, _reference_tables(t), t.orders_staged, root, AS_OF)
    totals = {
        "conformed_sales": F.sum("net_value_usd"), "weekly_store_demand": F.sum("total_kg"),
        "promo_lift": F.sum("promo_kg"), "on_shelf_availability": F.sum("on_hand_qty"),
    }
    parts = [
        tables.read_table(t.spark, build.gold_path(root, name)).agg(
            F.lit(name).alias("table_name"), F.lit(rows[name]).alias("rows_written"),
            F.count("*").alias("rows"), total.cast("decimal(38,4)").alias("total"),
        )
        for name, total in totals.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("C4")
def order_changes(t: Tables) -> DataFrame:
    old = t.raw_orders.select("record_id", "material_number", "order_qty", "net_value", "plant", "order_type")
    repriced = F.when(F.col("order_type") == "A", F.concat(F.lit("1"), "net_value")).otherwise(F.col("net_value"))
    kept = old.where(~((F.col("order_type") == "N") & (F.col("plant") == "PL00"))).withColumn("net_value", repriced)
    added = old.where(F.col("plant") == "PL01").withColumn("record_id", F.concat("record_id", F.lit("-B")))
    return changes.snapshot_diff(old, kept.unionByName(added), ["record_id"])


@query("C4")
def promo_changes(t: Tables) -> DataFrame:
    old = t.stg_promo.select("promo_id", "retailer_code", "start_date", "end_date", "discount_pct")
    longer = F.when(F.col("discount_pct") > 25, F.date_add("end_date", 7)).otherwise(F.col("end_date"))
    return changes.snapshot_diff(old, old.withColumn("end_date", longer), ["promo_id"])


@query("X3")
def new_product_versions(t: Tables) -> DataFrame:
    known = lookups.current_products(t.dim_product).select("material_number", "upc", "brand", "category", "avg_price_per_kg")
    raised = known.withColumn(
        "avg_price_per_kg", F.when(F.col("category") == "PROMO", F.col("avg_price_per_kg") + 1).otherwise(F.col("avg_price_per_kg"))
    )
    fresh = known.where(F.col("category") == "SMALL").withColumns(
        {"material_number": F.concat("material_number", F.lit("-N")), "upc": F.concat(F.lit("9"), F.substring("upc", 2, 11))}
    )
    return versions.apply_versions(
        t.dim_product, raised.unionByName(fresh), "material_number", ["avg_price_per_kg", "brand"], "2000-01-01"
    )


# --- tables kept up to date --------------------------------------------------------------


def _products_before(t: Tables) -> DataFrame:
    """The product master as it was when the gold tables were made: other weights and prices, and a category not yet sold."""
    heavier = F.when(F.col("category") == "PROMO", F.col("unit_weight_kg") * 2).otherwise(F.col("unit_weight_kg"))
    dearer = F.when(F.col("category") == "LARGE", F.col("avg_price_per_kg") + 3).otherwise(F.col("avg_price_per_kg"))
    before = t.dim_product.where(F.col("category") != "SMALL").withColumns({"unit_weight_kg": heavier, "avg_price_per_kg": dearer})
    return tables.conform(before, schemas.DIM_PRODUCT)


def _stores_before(t: Tables) -> DataFrame:
    return t.dim_store.withColumn("region", F.when(F.col("store_key") % 5 == 0, F.lit("elsewhere")).otherwise(F.col("region")))


def _rates_before(t: Tables) -> DataFrame:
    rows = t.dim_fx.where(~((F.col("currency_code") == "EUR") & (F.month("rate_date") == 3)))
    doubled = F.when(F.col("currency_code") == "CAD", F.col("rate_to_usd") * 2).otherwise(F.col("rate_to_usd"))
    return tables.conform(rows.withColumn("rate_to_usd", doubled), schemas.DIM_FX)


def _promos_before(t: Tables) -> DataFrame:
    """The landed calendar before some promotions were added, taken back and moved."""
    other_shop = F.when(F.col("promo_id").endswith("7"), F.lit("WMT")).otherwise(F.col("retailer_code"))
    rows = t.raw_promo.where(~F.col("promo_id").endswith("3")).withColumn("retailer_code", other_shop)
    return rows.unionByName(t.raw_promo.where(F.col("promo_id").endswith("5")).withColumn("promo_id", F.concat("promo_id", F.lit("-X"))))


@query("C4")
def applied_order_changes(t: Tables) -> DataFrame:
    """Orders, some repriced, dropped, added and doubled, brought to the feed as it is by the change set between the two."""
    new = t.raw_orders.select("record_id", "material_number", "order_qty", "net_value", "plant", "order_type")
    repriced = F.when(F.col("order_type") == "A", F.concat(F.lit("1"), "net_value")).otherwise(F.col("net_value"))
    old = new.where(F.col("plant") != "PL00").withColumn("net_value", repriced)
    old = old.unionByName(new.where(F.col("plant") == "PL01")).unionByName(new.where(F.col("plant") == "PL02").withColumn("record_id", F.concat("record_id", F.lit("-B"))))
    return deltas.apply_changes(old, changes.snapshot_diff(old, new, ["record_id"]))


@query("C4", "M3")
def refreshed_promotions(t: Tables) -> DataFrame:
    """The promotion fact follows edits of the calendar, one change set a load, and then of the product master."""
    path, before, products = _new_dir(t, "fct_promotions"), _promos_before(t), _products_before(t)
    edits = tables.stored(changes.snapshot_diff(before, t.raw_promo, ["promo_id"]), "calendar-edits")
    nothing = edits.limit(0)
    maintain.refresh_promotions(t.spark, path, before, nothing, maintain.same(products), "first")
    maintain.refresh_promotions(t.spark, path, before, edits, maintain.same(products), "calendar")
    maintain.refresh_promotions(t.spark, path, before, edits, maintain.same(products), "calendar")  # skipped
    maintain.refresh_promotions(t.spark, path, t.raw_promo, nothing, maintain.Versions(products, t.dim_product), "products")
    return tables.read_table(t.spark, path).drop("start_month")


@query("C6", "G1")
def refreshed_conformed_sales(t: Tables) -> DataFrame:
    """Orders land in two loads; then product versions and rates change."""
    path, products, rates = _new_dir(t, "conformed_sales"), _products_before(t), _rates_before(t)
    first = F.col("_loaded_at") <= F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    old, new = (tables.stored(t.orders_staged.where(c), "orders") for c in (first, ~first))
    nothing = Delta(old.limit(0), old.limit(0))
    maintain.refresh_conformed_sales(t.spark, path, old, nothing, maintain.same(products), maintain.same(rates), "first")
    maintain.refresh_conformed_sales(t.spark, path, old, Delta(new, new.limit(0)), maintain.Versions(products, t.dim_product), maintain.same(rates), "second")
    maintain.refresh_conformed_sales(t.spark, path, old.unionByName(new), nothing, maintain.same(t.dim_product), maintain.Versions(rates, t.dim_fx), "rates")
    return tables.read_table(t.spark, path).drop("order_month")


@query("C6", "G2")
def refreshed_weekly_demand_of_new_master(t: Tables) -> DataFrame:
    """As ``refreshed_weekly_demand``, and with the second load products and stores change as well."""
    root, weekly = _new_dir(t, "incremental"), _new_dir(t, "weekly_store_demand")
    first, second = _loads(t)
    _merge_sales(t, root, first)
    refresh.refresh_weekly_demand(t.spark, weekly, build.read_fact(t.spark, root, "fct_pos_sales", parts=True), _stores_before(t), _products_before(t))
    changed = _merge_sales(t, root, second).increment
    refresh.refresh_weekly_demand(
        t.spark, weekly, build.read_fact(t.spark, root, "fct_pos_sales", parts=True), t.dim_store, t.dim_product, changed, _stores_before(t), _products_before(t)
    )
    return tables.read_table(t.spark, weekly)


@query("C6", "G3")
def refreshed_promo_lift(t: Tables) -> DataFrame:
    """Sales land in two loads, the second with another calendar and product master; the fact is read in neither refresh."""
    root, daily, path = _new_dir(t, "incremental"), _new_dir(t, "daily_sales"), _new_dir(t, "promo_lift")
    products = maintain.Versions(_products_before(t), t.dim_product)
    promos = maintain.Versions(
        tables.stored(silver.fct_promotions(staging.stage_promo(_promos_before(t)), t.dim_product), "promotions"), tables.stored(t.fct_promotions, "promotions")
    )
    for i, landed in enumerate(_loads(t)):
        sales = maintain.sales_delta(_merge_sales(t, root, landed))
        maintain.refresh_daily_sales(t.spark, daily, sales, str(i))
        known = (promos, products) if i else (maintain.same(promos.old), maintain.same(products.old))
        maintain.refresh_promo_lift(t.spark, path, daily, sales, *known, str(i))
    return tables.read_table(t.spark, path).drop("start_month")


@query("C6", "G4", "F8")
def refreshed_availability(t: Tables) -> DataFrame:
    """Sales and snapshots land in two loads, nine days apart; stores and products change with the second."""
    root, demand, path = _new_dir(t, "incremental"), _new_dir(t, "demand"), _new_dir(t, "on_shelf_availability")
    days = ["2001-07-23", AS_OF]
    for i, (landed, stock) in enumerate(zip(_loads(t), _loads(t, "raw_inventory"), strict=True)):
        sales = maintain.sales_delta(_merge_sales(t, root, landed))
        maintain.refresh_demand(t.spark, demand, build.read_fact(t.spark, root, "fct_pos_sales"), sales if i else None, days[i])
        before = build.read_fact(t.spark, root, "fct_inventory") if i else None
        before = None if before is None else tables.stored(before, "stock-before")
        snapshots = maintain.sales_delta(_merge_inventory(t, root, stock))
        old = snapshots.added.limit(0) if before is None else before
        stores = maintain.Versions(_stores_before(t), t.dim_store) if i else maintain.same(_stores_before(t))
        products = maintain.Versions(_products_before(t), t.dim_product) if i else maintain.same(_products_before(t))
        kept = maintain.Versions(*(maintain.demand(t.spark, demand, d) for d in (days[0], days[i])))
        maintain.refresh_availability(t.spark, path, old, snapshots, stores, products, kept, str(i))
    return tables.read_table(t.spark, path).drop("snapshot_month")


@query("A4", "C6")
def kept_selling_days(t: Tables) -> DataFrame:
    """Distinct selling days from bits that two loads left."""
    root, path = _new_dir(t, "incremental"), _new_dir(t, "selling_days")
    for landed in _loads(t):
        maintain.refresh_selling_days(t.spark, path, maintain.sales_delta(_merge_sales(t, root, landed)))
    return maintain.selling_days(t.spark, path, t.dim_product)


# --- streaming ---------------------------------------------------------------------------


def _ingested_orders(t: Tables, runs: int = 1) -> tuple[str, list[int]]:
    """Ingests the landed orders ``runs`` times; returns the bronze root and the batches logged after each run."""
    root, batches = _new_dir(t, "bronze"), []
    for _ in range(runs):
        ingest.ingest_orders(t.spark, t.path("raw_orders"), root, RUN_TIME, max_files=4).awaitTermination()
        batches.append(t.spark.read.parquet(f"{root}/ingest_log/orders").count())
    return root, batches


@query("C1", "C3")
def stream_orders(t: Tables) -> DataFrame:
    return ingest.read_batches(t.spark, _ingested_orders(t)[0], "orders_staged")


@query("C1", "C3")
def stream_rejects(t: Tables) -> DataFrame:
    return ingest.read_batches(t.spark, _ingested_orders(t)[0], "orders_rejected")


@query("C2", "A10")
def stream_reruns(t: Tables) -> DataFrame:
    """Two runs over the same files: the second finds nothing and adds no batch."""
    root, batches = _ingested_orders(t, runs=2)
    log = t.spark.read.parquet(f"{root}/ingest_log/orders")
    counts = [F.regexp_extract("message", rf"{word}: (\d+)", 1).cast("bigint") for word in ("Staged", "Rejected")]
    return log.agg(F.sum(counts[0]).alias("staged"), F.sum(counts[1]).alias("rejected")).withColumn(
        "batches_of_second_run", F.lit(batches[1] - batches[0])
    )


@query("C1", "C5", "B3", "B5")
def stream_pos_audits(t: Tables) -> DataFrame:
    root = _new_dir(t, "bronze")
    ingest.ingest_pos(t.spark, t.path("raw_pos"), root, t.path("dim_store"), t.path("dim_fx"), AUDIT_AT).awaitTermination()
    return ingest.read_batches(t.spark, root, "pos_quality_log")


@query("C1", "B3")
def stream_pos(t: Tables) -> DataFrame:
    """The cleansed sales themselves, from several batches."""
    root = _new_dir(t, "bronze")
    ingest.ingest_pos(
        t.spark, t.path("raw_pos"), root, t.path("dim_store"), t.path("dim_fx"), AUDIT_AT, max_files=4
    ).awaitTermination()
    return ingest.read_batches(t.spark, root, "pos_cleansed")


@query("C1", "B4")
def stream_inventory(t: Tables) -> DataFrame:
    root = _new_dir(t, "bronze")
    ingest.ingest_inventory(t.spark, t.path("raw_inventory"), root, t.path("dim_store"), max_files=4).awaitTermination()
    return ingest.read_batches(t.spark, root, "inventory_cleansed")


@query("C6", "G2")
def refreshed_weekly_demand(t: Tables) -> DataFrame:
    """The fact grows in two runs; after the second only the touched weeks are rebuilt."""
    root, weekly = _new_dir(t, "incremental"), _new_dir(t, "weekly_store_demand")
    for landed in _loads(t):
        changed = _merge_sales(t, root, landed).increment
        refresh.refresh_weekly_demand(
            t.spark, weekly, build.read_fact(t.spark, root, "fct_pos_sales", parts=True), t.dim_store, t.dim_product, changed
        )
    return tables.read_table(t.spark, weekly)


# --- quality checks ------------------------------------------------------------------------


@query("Q-U")
def check_repeated_inventory_keys(t: Tables) -> DataFrame:
    return quality.duplicates(t.fct_inventory, "inventory_sk", include_null=False)


@query("Q-N")
def check_missing_sale_dates(t: Tables) -> DataFrame:
    return quality.missing(t.fct_pos_sales, "transaction_date").select("pos_sale_sk", "store_key", "upc", "units_sold")


@query("Q-N")
def check_missing_promo_starts(t: Tables) -> DataFrame:
    return quality.missing(t.fct_promotions, "start_date").select("promo_id", "retailer_code", "end_date")


@query("Q-R")
def check_negative_revenue(t: Tables) -> DataFrame:
    return quality.below(t.fct_pos_sales, "revenue").select("pos_sale_sk", "store_key", "upc", "revenue")


@query("Q-F", "J12")
def check_orphan_promos(t: Tables) -> DataFrame:
    return quality.orphans(t.fct_promotions, t.dim_product, "material_number", "material_number")


@query("Q-F", "J12")
def check_orphan_promos_or_null(t: Tables) -> DataFrame:
    return quality.orphans(t.fct_promotions, t.dim_product, "material_number", "material_number", include_null=True)


@query("Q-O")
def check_inverted_promos(t: Tables) -> DataFrame:
    return quality.inverted(t.fct_promotions).select("promo_id", "start_date", "end_date")


def _checked(t: Tables) -> dict[str, DataFrame]:
    """Checks run on built tables: the facts are written before they are tested."""
    facts = ("fct_pos_sales", "fct_inventory", "fct_promotions")
    return {**{n: tables.stored(getattr(t, n), n) for n in facts}, "dim_store": t.dim_store, "dim_product": t.dim_product}


@query("Q-S", "Q-U", "Q-N", "Q-R", "Q-F")
def quality_report(t: Tables) -> DataFrame:
    return quality.run_checks(_checked(t), quality.MODEL_CHECKS)


@query("Q-S", "Q-U", "Q-R", "Q-F", "Q-O")
def assertion_report(t: Tables) -> DataFrame:
    return quality.run_checks(_checked(t), quality.ASSERTIONS)
