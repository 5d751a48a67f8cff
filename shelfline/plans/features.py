"""Features for demand forecasting, one row per store, product and day with sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfline.functions.measures import mean, ratio

# Fixed value: the day numbers counted as weekend.
WEEKEND_DAYS = (6, 7)


def daily_store_sales(cleansed: DataFrame) -> DataFrame:
    """Sales per store, product and day; the sums are combined before the shuffle."""
    return cleansed.sparkSession.sql(
        """
        SELECT store_key, upc, transaction_date,
               sum(units_sold) AS daily_units,
               sum(revenue_usd) AS daily_revenue,
               max(CAST(promo_flag AS INT)) AS had_promo
        FROM {cleansed}
        GROUP BY store_key, upc, transaction_date
        """,
        cleansed=cleansed,
    )


def _day_number(column: str, week_start: int) -> Column:
    """0 = Sunday .. 6 = Saturday, or with ``week_start=1`` 1 = Monday .. 7 = Sunday."""
    return F.weekday(column) + 1 if week_start == 1 else F.dayofweek(column) - 1


def demand_features(cleansed: DataFrame, week_start: int = 0) -> DataFrame:
    """Rolling averages, growth, calendar flags and recent promotion days.

    Windows count rows, not days. All of them share one partitioning and order, hence
    one sort; a series is no longer than the calendar, whatever its raw row count.
    """
    return _features(daily_store_sales(cleansed), ["store_key", "upc"], week_start)


def _features(daily: DataFrame, series_key: list[str], week_start: int) -> DataFrame:
    series = Window.partitionBy(*series_key).orderBy(F.asc_nulls_last("transaction_date"))
    week, month = series.rowsBetween(-6, 0), series.rowsBetween(-27, 0)
    units, revenue = F.col("daily_units"), F.col("daily_revenue")
    return (
        daily.select(
            "*",
            mean(units, week).alias("units_7d_avg"),
            mean(units, month).alias("units_28d_avg"),
            mean(revenue, week).alias("revenue_7d_avg"),
            F.lag("daily_units", 7).over(series).alias("prev_week_units"),
            F.sum("had_promo").over(week).alias("promo_running_count"),
        )
        .withColumns(
            {
                "wow_growth": ratio(units - F.col("prev_week_units"), F.col("prev_week_units")),
                "day_of_week": _day_number("transaction_date", week_start),
                "month_num": F.month("transaction_date"),
            }
        )
        .withColumn("is_weekend", F.when(F.col("day_of_week").isin(*WEEKEND_DAYS), 1).otherwise(0))
        .drop("prev_week_units")
    )


def demand_features_by_calendar(cleansed: DataFrame, week_start: int = 0) -> DataFrame:
    """``demand_features`` over calendar days: a day without sales counts as one with nothing sold.

    Such days are not spelled out. Frames are ranges of day numbers, so a sum over the last seven days takes the rows there are; it is
    divided by seven, or by the days since the series began if these are fewer. Growth is against the day a week before,
    zero if nothing was sold then, and unknown before the series began. Rows without a date have no place in a calendar and are left out.
    """
    daily = daily_store_sales(cleansed).where(F.col("transaction_date").isNotNull()).withColumn("_day", F.unix_date("transaction_date"))
    series = Window.partitionBy("store_key", "upc").orderBy("_day")
    week, month, week_ago = series.rangeBetween(-6, 0), series.rangeBetween(-27, 0), series.rangeBetween(-7, -7)
    age = F.col("_day") - F.min("_day").over(series) + 1

    def average(column: str, frame: WindowSpec, days: int) -> Column:
        return ratio(F.coalesce(F.sum(column).over(frame), F.lit(0)), F.least(F.lit(days), age))

    before = F.when(age > 7, F.coalesce(F.sum("daily_units").over(week_ago), F.lit(0)))
    return (
        daily.select(
            "*",
            average("daily_units", week, 7).alias("units_7d_avg"),
            average("daily_units", month, 28).alias("units_28d_avg"),
            average("daily_revenue", week, 7).alias("revenue_7d_avg"),
            F.sum("had_promo").over(week).alias("promo_running_count"),
            before.alias("_before"),
        )
        .withColumns(
            {
                "wow_growth": ratio(F.coalesce("daily_units", F.lit(0)) - F.col("_before"), F.col("_before")),
                "day_of_week": _day_number("transaction_date", week_start),
                "month_num": F.month("transaction_date"),
            }
        )
        .withColumn("is_weekend", F.when(F.col("day_of_week").isin(*WEEKEND_DAYS), 1).otherwise(0))
        .drop("_before", "_day")
    )


def demand_features_with_stockouts(cleansed: DataFrame, inventory: DataFrame, week_start: int = 0) -> DataFrame:
    """``demand_features`` plus the days since the last snapshot with nothing on hand.

    The snapshot may be of the row's own day. Stock-out days join the series as rows of
    their own, so a running maximum finds the latest one and no row is compared with all
    earlier ones. They are kept out of the feature windows by their flag; both windows
    run on one shuffle by store and product.
    """
    day_key = ["store_key", "upc", "transaction_date"]
    stockouts = (
        inventory.where(
            (F.col("on_hand_qty") == 0) & F.col("store_key").isNotNull() & F.col("upc").isNotNull()
        )
        .groupBy("store_key", "upc", F.col("snapshot_date").alias("transaction_date"))
        .agg(F.max("snapshot_date").alias("_out"))
    )
    sold = daily_store_sales(cleansed).withColumn("_sold", F.lit(True))
    so_far = (
        Window.partitionBy("store_key", "upc")
        .orderBy(F.asc_nulls_last("transaction_date"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    days = (
        sold.join(stockouts, day_key, "full")
        .withColumn("_last_out", F.max("_out").over(so_far))
        .withColumn("days_since_stockout", F.datediff("transaction_date", "_last_out"))
        .drop("_out", "_last_out")
    )
    return _features(days, ["store_key", "upc", "_sold"], week_start).where(F.col("_sold")).drop("_sold")
