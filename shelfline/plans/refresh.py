"""Keeping gold tables fresh."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.operators.deltas import Delta
from shelfline.operators.lookups import current_products, if_small
from shelfline.plans.gold import weekly_store_demand
from shelfline.sources.tables import empty_folder, folders_of, overwrite, stored, table_exists, write_clustered


def rebuild(build: Callable[[], DataFrame], path: str) -> int:
    """Computes a table anew and replaces it; returns its row count."""
    return overwrite(build(), path)


def refresh_weekly_demand(
    spark: SparkSession,
    path: str,
    pos: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    changed: DataFrame | None = None,
    stores_before: DataFrame | None = None,
    products_before: DataFrame | None = None,
) -> None:
    """Brings the weekly table up to date after the rows ``changed`` reached ``pos``, or left it.

    Only the weeks that ``changed`` has days in are recomputed, and with ``stores_before`` or ``products_before``, the reference tables
    that the weekly table was made of, the weeks with sales of stores or products that differ. Weeks are few; they are
    named day by day in the filter, which prunes a fact partitioned by day. A fact partitioned by
    ``transaction_date_month`` is pruned by the months of these days. A week that has no sales any more loses its rows.
    """
    week = F.trunc("transaction_date", "week").alias("week_start")
    rows, touched = pos, None
    if changed is not None and table_exists(spark, path):
        touched = changed.select(week)
        for before, now, key, used in (
            (stores_before, stores, "store_key", ["store_key", "retailer_name", "region", "store_name", "store_id"]),
            (products_before, products, "upc", ["upc", "brand", "category", "sub_category", "unit_weight_kg"]),
        ):
            if before is not None:
                versions = [(current_products(t) if key == "upc" else t).select(*used) for t in (before, now)]
                keys = if_small(stored(Delta.between(*versions, [key]).keys(key), "changed-keys"))
                touched = touched.unionByName(pos.join(keys, key, "left_semi").select(week))
        touched = stored(touched.distinct(), "touched-weeks")
        weeks = [row.week_start for row in touched.collect()]
        days = [w + timedelta(days=i) for w in weeks if w is not None for i in range(7)]
        in_weeks = F.col("transaction_date").isin(days)
        if "transaction_date_month" in pos.columns:
            in_weeks = in_weeks & F.col("transaction_date_month").isin(sorted({d.replace(day=1) for d in days}))
        rows = pos.where(in_weeks | F.col("transaction_date").isNull() if None in weeks else in_weeks)
    found = weekly_store_demand(rows, stores, products)
    if touched is None:
        write_clustered(found, path, "week_start", ["store_id", "brand", "category"])
        return
    found = stored(found, "weekly-demand")
    left = touched.join(found.select("week_start").distinct().withColumnRenamed("week_start", "_week"), F.col("week_start").eqNullSafe(F.col("_week")), "left_anti")
    emptied = folders_of(spark.read.parquet(path), left)
    write_clustered(found, path, "week_start", ["store_id", "brand", "category"], only_touched=True)
    for folder in emptied:
        empty_folder(spark, folder, found.drop("week_start").schema)


def refresh_on_change(
    stream: DataFrame, job: Callable[[DataFrame], None], checkpoint: str, lag: str | None = None
) -> StreamingQuery:
    """Runs ``job`` on each batch of new rows, every ``lag`` or once over what is there."""
    trigger = {"processingTime": lag} if lag else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(lambda batch, _: job(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
