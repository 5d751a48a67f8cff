"""Times the headline queries and prints one JSON line.

Three queries run first on the smallest folder and take the one-off costs (JVM start,
class loading). ``landing_feeds`` is the time to derive the landing and reference tables
from the given tables; it counts in the total. Each query then runs once; its rows go to
the ``noop`` sink, so all of them are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import time

from shelfline.catalog.feeds import LANDED, Feeds
from shelfline.catalog.queries import run
from shelfline.session import build_session

HEADLINE = (
    "stage_orders", "quarantine_orders", "cleanse_pos", "cleanse_inventory", "pos_quality_audit",
    "enrich_pos", "latest_sales", "stg_pos", "stg_inventory", "stg_promo",
    "fct_pos_sales", "fct_pos_sales_from_bronze", "fct_inventory", "fct_promotions", "dim_product_versions",
    "demand_features", "days_since_stockout",
    "conformed_sales", "weekly_store_demand", "promo_lift", "promo_lift_by_retailer", "on_shelf_availability",
    "incremental_pos_sales", "incremental_inventory", "order_changes", "new_product_versions",
    "stream_orders", "stream_pos_audits", "refreshed_weekly_demand",
    "quality_report", "assertion_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", cores=int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in ("weekly_store_demand", "demand_features", "stream_orders"):
            run(name, spark, warm).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    start = time.perf_counter()
    feeds = Feeds(spark, sf_dir)
    for name in LANDED:
        getattr(feeds, name)
    seconds["landing_feeds"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
