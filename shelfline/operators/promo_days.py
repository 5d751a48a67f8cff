"""Sales on and off promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.lookups import BROADCAST_LIMIT, join_folded
from shelfline.sources.tables import stored


def daily_sales(pos: DataFrame) -> DataFrame:
    """Sales folded to product, retailer and day.

    Everything the lift analysis needs is a sum or a row count, so this is the only
    step that reads the fact at its own grain; a product that holds a third of the
    rows shrinks to one row per day before any join.
    """
    return pos.groupBy("upc", "retailer_code", "transaction_date").agg(
        F.sum("units_sold").alias("day_units"),
        F.count("units_sold").alias("day_rows"),
        F.sum("revenue_usd").alias("day_revenue_usd"),
    )


def running(promos: DataFrame, daily: DataFrame) -> DataFrame:
    """Promotions with ``first_day`` and ``last_day``: their window cut to the days ``daily`` spans.

    No sale lies outside, so nothing is lost, and an open-ended promotion becomes no
    longer than the sales history. ``daily`` should be a stored table; it is scanned
    for two values. Promotions that end before they start, or lack a date, have no days.
    """
    span = daily.agg(F.min("transaction_date").alias("low"), F.max("transaction_date").alias("high")).first()
    return (
        promos.where(F.col("start_date") <= F.col("end_date"))
        .withColumn("first_day", F.greatest("start_date", F.lit(span["low"]).cast("date")))
        .withColumn("last_day", F.least("end_date", F.lit(span["high"]).cast("date")))
        .where(F.col("first_day") <= F.col("last_day"))
    )


def _months(promos: DataFrame, first: str, last: str) -> DataFrame:
    """One row per promotion and calendar month of its window, with ``month``."""
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return promos.where(F.col(first) <= F.col(last)).withColumn("month", F.explode(months))


def covered_days(promos: DataFrame, first: str = "start_date", last: str = "end_date") -> DataFrame:
    """Distinct (retailer, day) with at least one promotion running.

    Windows are first cut at month ends and deduplicated: long ones overlap in whole
    months, so their days are spelled out once, not once per promotion.
    """
    parts = (
        _months(promos.where(F.col("promo_id").isNotNull()), first, last)
        .select(
            "retailer_code", F.greatest(first, "month").alias("_from"), F.least(last, F.last_day("month")).alias("_to")
        )
        .distinct()
    )
    return parts.select(
        "retailer_code", F.explode(F.sequence("_from", "_to")).alias("transaction_date")
    ).distinct()


def _month_number(day: str) -> Column:
    return F.year(day) * 12 + F.month(day)


def retailer_days(promos: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame | None:
    """One row per retailer with a bit for each day of a month, by the month's number: ``_known`` of the days on which a promotion
    with an id runs, ``_any`` of those on which any runs. Marked for broadcast; None if the bits take up more than ``limit``
    bytes. ``promos`` as from ``running``.
    """
    first, last = "dayofmonth(greatest(first_day, month))", "dayofmonth(least(last_day, last_day(month)))"
    bits = F.expr(f"shiftleft(1L, {last}) - shiftleft(1L, {first} - 1)")
    months = _months(promos.where(F.col("retailer_code").isNotNull()), "first_day", "last_day")
    by_month = months.groupBy("retailer_code", _month_number("month").alias("number")).agg(
        F.bit_or(F.when(F.col("promo_id").isNotNull(), bits).otherwise(0)).alias("known"), F.bit_or(bits).alias("any")
    )
    entries = [F.map_from_entries(F.collect_list(F.struct("number", c))).alias(f"_{c}") for c in ("known", "any")]
    days = stored(by_month.groupBy("retailer_code").agg(*entries), "retailer_days")
    # Two numbers of eight bytes each for a month, in both maps.
    size = days.agg(F.sum(F.size("_known") * 32 + F.octet_length("retailer_code") + 64)).first()[0] or 0
    return F.broadcast(days) if size <= limit else None


def _marked(daily: DataFrame, days: DataFrame, kind: str) -> DataFrame:
    """``daily`` with ``_on``, whether the day is one of the retailer's; null where it has none in that month."""
    bits = F.try_element_at(F.col(kind), _month_number("transaction_date"))
    on = F.getbit(bits, F.dayofmonth("transaction_date") - 1) == 1
    return daily.join(days.select("retailer_code", kind), "retailer_code", "left").withColumn("_on", on).drop(kind)


def without_promo(daily: DataFrame, promos: DataFrame, days: DataFrame | None) -> DataFrame:
    """``off_promo``, by a lookup that shuffles no sales if the ``retailer_days`` of the promotions are given."""
    if days is None:
        return off_promo(daily, promos)
    return _marked(daily, days, "_known").where(~F.coalesce("_on", F.lit(False))).drop("_on")


def on_any_promo_day(daily: DataFrame, days: DataFrame | None) -> DataFrame:
    """Daily sales on days with any promotion at the retailer, the only ones that ``on_promo`` can find; all if no ``days`` are given."""
    return daily if days is None else _marked(daily, days, "_any").where("_on").drop("_on")


def off_promo(daily: DataFrame, promos: DataFrame) -> DataFrame:
    """Days on which no promotion of any product ran at the retailer; ``promos`` as from ``running``.

    An equality anti join on (retailer, day) in place of a range join on the retailer
    alone, which has few values.
    """
    days = covered_days(promos, "first_day", "last_day")
    # The null-safe form lets Spark split a hot (retailer, day): see join_folded. Sales lacking either are kept.
    known = daily.where(F.col("retailer_code").isNotNull() & F.col("transaction_date").isNotNull())
    unknown = daily.where(F.col("retailer_code").isNull() | F.col("transaction_date").isNull())
    return join_folded(known, days, ["retailer_code", "transaction_date"], "left_anti").unionByName(unknown)


def on_promo(daily: DataFrame, promos: DataFrame) -> DataFrame:
    """Daily sales of the promoted product at the promoting retailer; ``promos`` as from ``running``.

    Joined month by month: a product that is on sale all the time spreads over the
    months, and a promotion meets a month's days at most, not the whole history.
    """
    calendar = _months(promos, "first_day", "last_day")
    by_month = daily.withColumn("month", F.trunc("transaction_date", "month"))
    return calendar.join(by_month, ["upc", "retailer_code", "month"]).where(
        F.col("transaction_date").between(F.col("first_day"), F.col("last_day"))
    )
