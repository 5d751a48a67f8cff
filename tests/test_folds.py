"""Sums that are added up before their one shuffle."""

import re
from datetime import date

from pyspark.sql import functions as F

from shelfline.plans import gold


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def products(spark, *rows):
    df = spark.createDataFrame(rows, "upc string, unit_weight_kg int, brand string, category string, sub_category string, is_current boolean")
    return df.withColumn("unit_weight_kg", F.col("unit_weight_kg").cast("decimal(10,4)"))


def test_weeks_are_shuffled_once_and_count_distinct_days(spark):
    sales = [
        (1, "u", "2024-01-01", 2), (2, "u", "2024-01-01", 3), (1, "v", "2024-01-01", 5), (1, "u", "2024-01-07", 1),
        (1, "u", "2024-01-07", 1), (1, "u", "2024-01-08", 4), (1, "u", None, 7), (1, "v", None, None),
    ]
    pos = spark.createDataFrame(sales, "store_key bigint, upc string, day string, units int").select(
        "store_key", "upc", F.col("day").cast("date").alias("transaction_date"), F.col("units").cast("decimal(18,0)").alias("units_sold"),
        F.col("units").cast("decimal(18,2)").alias("revenue_usd"),
    )
    # Two shops of the same name and id, as a reference table may hold them, are one row of the weekly table.
    stores = spark.range(1, 3).select(F.col("id").alias("store_key"), *[F.lit(n).alias(n) for n in ("retailer_name", "region", "store_name", "store_id")])
    weekly = gold.weekly_store_demand(pos, F.broadcast(stores), F.broadcast(products(spark, ("u", 2, "b", "c", "s", True), ("v", 1, "b", "c", "s", True))))
    assert len(re.findall("Exchange hashpartitioning", plan(weekly))) == 2
    got = {r.week_start: (int(r.total_units), float(r.total_kg), r.selling_days, r.avg_daily_kg) for r in weekly.collect()}
    assert got == {date(2024, 1, 1): (12, 19.0, 2, 9.5), date(2024, 1, 8): (4, 8.0, 1, 8.0), None: (7, 14.0, 0, None)}
    assert dict(weekly.dtypes)["selling_days"] == "bigint"
