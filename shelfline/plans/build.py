"""The whole way from landed feeds to gold, as two ordered jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import numbering
from shelfline.operators.lookups import if_small
from shelfline.operators.quality import MODEL_CHECKS, run_checks, stop_on_errors
from shelfline.operators.upsert import UpsertResult, after_mark, finish_interrupted, newer_than, spread_evenly, stored_mark, upsert
from shelfline.plans import features, gold, silver, staging
from shelfline.plans.refresh import rebuild
from shelfline.sources.raw import register_views
from shelfline.sources.tables import read_table, stored, table_exists, write_sorted

# Fact -> (its date, the key it is merged on).
FACTS = {
    "fct_pos_sales": ("transaction_date", "pos_sale_sk"),
    "fct_inventory": ("snapshot_date", "inventory_sk"),
}


# What the lookups read of the stores, and so what is measured for a broadcast.
STORE_KEYS = ["retailer_code", "store_id", "store_key"]
STORE_TEXTS = ["store_key", "retailer_name", "region", "store_name", "store_id"]


def silver_path(root: str, table: str) -> str:
    return f"{root}/silver/{table}"


def gold_path(root: str, table: str) -> str:
    return f"{root}/gold/{table}"


_DECLARED = {"fct_pos_sales": schemas.FCT_POS_SALES, "fct_inventory": schemas.FCT_INVENTORY, "fct_promotions": schemas.FCT_PROMOTIONS}
# A part of their key by which facts are folded where it has dealt their rows: sales by the join to the products, stock by a shuffle
# of the landed rows, which are narrower than the fact's.
DEALT_BY = {"fct_pos_sales": "upc", "fct_inventory": "upc"}
# Rows without a date have no day to lie under; they are dealt to so many folders by their key.
UNDATED_SHARES = 64


def fact_parts(table: str, by: str = "day") -> list[str]:
    """Partition columns of a fact: its day or month, then the share of a row without a date."""
    date, _ = FACTS[table]
    return [date if by == "day" else f"{date}_{by}", "undated_share"]


def merge_fact(
    spark: SparkSession, root: str, table: str, landed: DataFrame, make, by: str = "day", full: bool = False, lookback: str | None = None
) -> UpsertResult:
    """Brings a fact up to date with the rows landed since its newest one.

    ``make`` turns landed rows into fact rows. Partitions are days; ``by="month"`` suits
    tables with few rows a day. ``full`` rebuilds the fact from all landed rows. ``lookback`` (such as
    ``'2 hours'``) also takes rows that landed so long before the newest one. The newest load time is the one that the last
    merge stored; only a table written by other means is scanned for it. A row without a date is merged within one of
    ``UNDATED_SHARES`` folders, which follows from its key. Rows are folded where they have been dealt by ``upc``, unless one product holds
    so many of them that its rows should be split.
    """
    path, (date, key) = silver_path(root, table), FACTS[table]
    parts, order = fact_parts(table, by), [date, "retailer_code"]
    finish_interrupted(spark, path, parts, order)
    if not full and table_exists(spark, path):
        mark = stored_mark(spark, path)
        if mark is None:
            landed = newer_than(landed, read_table(spark, path), "_loaded_at", "_loaded_at", lookback)
        else:
            landed = after_mark(landed, "_loaded_at", mark, lookback)
    dealt_by = DEALT_BY[table] if spread_evenly(landed, DEALT_BY[table]) else None
    if dealt_by and table == "fct_inventory":
        landed = landed.repartition(dealt_by)
    share = F.when(F.col(date).isNull(), F.pmod(F.xxhash64(key), F.lit(UNDATED_SHARES))).otherwise(0).cast("int")
    rows = make(landed).withColumn("undated_share", share)
    if by != "day":
        rows = rows.withColumn(parts[0], F.trunc(date, by))
    return upsert(spark, path, rows, key, parts, cluster_by=order, mode="full" if full else "merge", dealt_by=dealt_by)


def plain_rows(fact: DataFrame) -> DataFrame:
    """A fact without the columns that only name its folders."""
    return fact.drop("undated_share", *[c for c in fact.columns if c.endswith("_month")])


def read_fact(spark: SparkSession, root: str, table: str, parts: bool = False) -> DataFrame:
    """The fact; with ``parts`` also the columns it is partitioned by. One that has no rows yet has its declared columns."""
    path = silver_path(root, table)
    if not table_exists(spark, path):
        return spark.createDataFrame([], _DECLARED[table])
    df = read_table(spark, path)
    return df if parts else plain_rows(df)


def build_silver(
    spark: SparkSession,
    feeds: Mapping[str, DataFrame],
    reference: Mapping[str, DataFrame],
    root: str,
    by: str = "day",
    full: bool = False,
    stop: bool = True,
    layouts: staging.Layouts = staging.Layouts(),
    lookback: str | None = None,
) -> DataFrame:
    """Staging views, the two merged facts, the rebuilt promotions, then the checks on them.

    ``layouts`` are the date layouts of the feeds; ``lookback`` is for rows that land late, see ``merge_fact``. ``feeds``: raw_pos, raw_inventory, raw_promo. ``reference``: dim_product, dim_store,
    dim_fx. Returns the check report, a stored table. A failed check of severity ``error`` stops the build with
    ``ChecksFailed``, so that no gold table is made of such facts; ``stop=False`` only reports it.
    """
    stores, products, fx = (if_small(t) for t in (reference["dim_store"].select(*STORE_KEYS), reference["dim_product"], reference["dim_fx"]))

    def stage_pos(rows: DataFrame) -> DataFrame:
        return staging.stage_pos(rows, layouts.sales, layouts.sales_default)

    def stage_inventory(rows: DataFrame) -> DataFrame:
        return staging.stage_inventory(rows, layouts.snapshots)

    staged = {
        "stg_pos": stage_pos(feeds["raw_pos"]),
        "stg_inventory": stage_inventory(feeds["raw_inventory"]),
        "stg_promo": staging.stage_promo(feeds["raw_promo"], layouts.promotions),
    }
    register_views(spark, staged)
    merge_fact(
        spark, root, "fct_pos_sales", feeds["raw_pos"],
        lambda landed: silver.fct_pos_sales(stage_pos(landed), stores, products, fx), by, full, lookback,
    )
    merge_fact(
        spark, root, "fct_inventory", feeds["raw_inventory"],
        lambda landed: silver.fct_inventory(stage_inventory(landed), stores), by, full, lookback,
    )
    rebuild(lambda: silver.fct_promotions(staged["stg_promo"], products), silver_path(root, "fct_promotions"))
    built = {n: read_fact(spark, root, n) for n in (*FACTS, "fct_promotions")}
    report = stored(run_checks({**built, "dim_store": stores, "dim_product": products}, MODEL_CHECKS), "check_report")
    if stop:
        stop_on_errors(report)
    return report


def build_silver_from_bronze(
    spark: SparkSession, cleansed_pos: DataFrame, cleansed_inventory: DataFrame, products: DataFrame, root: str, by: str = "day", full: bool = False, lookback: str | None = None
) -> dict[str, UpsertResult]:
    """The facts of the other lineage, merged from the cleansed bronze tables, and the features.

    Keys are null here for rows of unknown stores or days; the results' ``rejects`` hold these rows.
    """
    products = if_small(products)
    done = {
        "fct_pos_sales": merge_fact(
            spark, root, "fct_pos_sales", cleansed_pos, lambda rows: silver.fct_pos_sales_from_bronze(rows, products), by, full, lookback
        ),
        "fct_inventory": merge_fact(
            spark, root, "fct_inventory", cleansed_inventory, silver.fct_inventory_from_bronze, by, full, lookback
        ),
    }
    build_features(cleansed_pos, root)
    return done


def build_features(cleansed: DataFrame, root: str) -> int:
    """Rebuilds the forecasting features from the cleansed sales; returns the row count."""
    return rebuild(lambda: features.demand_features(cleansed), silver_path(root, "demand_features"))


def build_product_versions(products: DataFrame, root: str, updated_at: str | None = None) -> None:
    """Rebuilds the numbered product dimension, sorted by brand and category.

    A version keeps the number it was given first, whatever is added later; ``product_numbers`` holds them.
    """
    key = ["material_number", "effective_from"]
    numbers = numbering.allocate(products, silver_path(root, "product_numbers"), "product_sk", key)
    versions = silver.numbered_product_versions(numbering.with_numbers(products, numbers, key), updated_at)
    write_sorted(versions, silver_path(root, "dim_product_versions"), ["brand", "category"])


def build_gold(
    spark: SparkSession,
    reference: Mapping[str, DataFrame],
    orders_staged: DataFrame,
    root: str,
    as_of: str | None = None,
) -> dict[str, int]:
    """Rebuilds the four gold tables from the silver tables; returns their row counts."""
    stores, products, fx = (if_small(t) for t in (reference["dim_store"].select(*STORE_TEXTS), reference["dim_product"], reference["dim_fx"]))
    pos, stock, promos = (read_fact(spark, root, n) for n in (*FACTS, "fct_promotions"))
    jobs = {
        "conformed_sales": lambda: gold.conformed_sales(orders_staged, products, fx),
        "weekly_store_demand": lambda: gold.weekly_store_demand(pos, stores, products),
        "promo_lift": lambda: gold.promo_lift(promos, products, pos),
        "on_shelf_availability": lambda: gold.on_shelf_availability(stock, stores, products, pos, as_of),
    }
    return {name: rebuild(job, gold_path(root, name)) for name, job in jobs.items()}
