"""The seed rows through every job, against known results."""

import pytest
from pyspark.sql import functions as F

from seeds import PRODUCTS, seed_tables
from shelfline.functions.parsing import check_digit_ok
from shelfline.operators.quality import ASSERTIONS, MODEL_CHECKS, run_checks
from shelfline.plans import bronze, features, gold, silver, staging


@pytest.fixture(scope="module")
def t(spark):
    t = seed_tables(spark)
    t["pos_cleansed"] = bronze.cleanse_pos(t["raw_pos"], t["dim_store"], t["dim_fx"])
    t["fct_pos_sales"] = silver.fct_pos_sales(
        staging.stage_pos(t["raw_pos"]), t["dim_store"], t["dim_product"], t["dim_fx"]
    )
    t["fct_inventory"] = silver.fct_inventory(staging.stage_inventory(t["raw_inventory"]), t["dim_store"])
    t["fct_promotions"] = silver.fct_promotions(staging.stage_promo(t["raw_promo"]), t["dim_product"])
    return {k: df.persist() for k, df in t.items()}


def test_all_sales_pass(t):
    row = t["fct_pos_sales"].agg(
        F.count("*").alias("n"),
        F.count_distinct("pos_sale_sk").alias("keys"),
        F.count("transaction_date").alias("dates"),
        F.sum("kg_sold").alias("kg"),
        F.count_if(F.col("revenue") != F.col("revenue_usd")).alias("converted"),
    ).first()
    assert (row.n, row.keys, row.dates, float(row.kg), row.converted) == (15, 15, 15, 292.3585, 0)
    assert t["pos_cleansed"].count() == 15


def test_orders_all_staged(t):
    row = bronze.order_counts(t["raw_orders"]).first()
    assert (row.staged, row.rejected, row.message) == (8, 0, "Staged: 8 rows. Rejected: 0 rows.")
    assert bronze.stage_orders(t["raw_orders"]).count() == 8
    assert bronze.quarantine_orders(t["raw_orders"]).count() == 0


def test_pipeline_quantities(t):
    rows = t["fct_inventory"].select("total_pipeline_qty").collect()
    assert sorted(int(r[0]) for r in rows) == sorted([370, 450, 335, 115, 240, 200, 275, 505])


def test_promo_durations(t):
    rows = t["fct_promotions"].orderBy("promo_id").collect()
    assert [int(r.promo_duration_days) for r in rows] == [14, 7, 10, 21]
    assert [r.upc[-3:] for r in rows] == ["012", "029", "043", "050"]


def test_order_weights(t):
    rows = gold.conformed_sales(bronze.stage_orders(t["raw_orders"]), t["dim_product"], t["dim_fx"])
    rows = rows.orderBy("sales_order_id").collect()
    assert [float(r.order_weight_kg) for r in rows] == [100, 83, 476.4, 900, 150, 1400, 20, 75]
    assert all(r.net_value == r.net_value_usd for r in rows)


def test_weekly_demand(t):
    rows = gold.weekly_store_demand(t["fct_pos_sales"], t["dim_store"], t["dim_product"]).collect()
    got = {
        (r.store_id, r.brand): (
            int(r.total_units), float(r.total_kg), float(r.total_revenue_usd), r.selling_days, round(r.avg_daily_kg, 6),
        )
        for r in rows
    }
    assert {str(r.week_start) for r in rows} == {"2024-10-28"}
    assert got == {
        ("WMT-4201", "Sunrise"): (97, 19.4, 630.5, 2, 9.7),
        ("WMT-4201", "ChocoCrunch"): (215, 8.9225, 321.0, 2, 4.46125),
        ("WMT-4502", "Sunrise"): (38, 7.6, 247.0, 1, 7.6),
        ("WMT-4502", "CrystalSpring"): (95, 71.25, 171.0, 1, 71.25),
        ("WMT-3108", "PetPrime"): (22, 34.936, 237.6, 1, 34.936),
        ("KRO-0531", "Sunrise"): (58, 11.6, 377.0, 2, 5.8),
        ("KRO-0531", "QuickBite"): (85, 29.75, 124.95, 1, 29.75),
        ("KRO-0842", "ChocoCrunch"): (60, 3.0, 89.4, 1, 3.0),
        ("TGT-1892", "Sunrise"): (100, 20.0, 650.0, 2, 10.0),
        ("TGT-1892", "PetPrime"): (40, 3.4, 42.5, 1, 3.4),
        ("TGT-2104", "CrystalSpring"): (110, 82.5, 198.0, 1, 82.5),
    }


def test_promo_lift_without_baseline(t):
    rows = gold.promo_lift(t["fct_promotions"], t["dim_product"], t["fct_pos_sales"]).orderBy("promo_id").collect()
    assert [
        (r.promo_id[-3:], float(r.promo_kg), float(r.promo_revenue), round(r.promo_daily_kg, 7)) for r in rows
    ] == [
        ("001", 27.0, 877.5, 1.9285714),
        ("002", 8.9225, 321.0, 1.2746429),
        ("003", 29.75, 124.95, 2.975),
        ("004", 82.5, 198.0, 3.9285714),
    ]
    assert all(
        (r.baseline_daily_kg, r.lift_pct, r.incremental_revenue_est, r.promo_roi) == (None,) * 4 for r in rows
    )


def test_availability(t):
    rows = gold.on_shelf_availability(
        t["fct_inventory"], t["dim_store"], t["dim_product"], t["fct_pos_sales"], "2024-11-02"
    )
    got = {
        (r.store_id, r.brand): (
            r.avg_daily_units, round(r.days_of_supply, 4), round(r.days_of_supply_incl_transit, 4), r.availability_status,
        )
        for r in rows.collect()
    }
    assert got == {
        ("WMT-4201", "Sunrise"): (48.5, 2.4742, 3.5052, "CRITICAL"),
        ("WMT-4201", "ChocoCrunch"): (107.5, 3.2558, 4.1860, "LOW"),
        ("WMT-4502", "Sunrise"): (38, 2.2368, 3.5526, "CRITICAL"),
        ("WMT-3108", "PetPrime"): (22, 0.6818, 0.6818, "CRITICAL"),
        ("KRO-0531", "Sunrise"): (29, 2.0690, 3.1034, "CRITICAL"),
        ("KRO-0531", "QuickBite"): (85, 2.3529, 2.3529, "CRITICAL"),
        ("TGT-1892", "Sunrise"): (50, 0.0, 1.5, "OUT_OF_STOCK"),
        ("TGT-2104", "CrystalSpring"): (110, 0.0455, 0.0455, "CRITICAL"),
    }


def test_availability_without_recent_sales(t):
    rows = gold.on_shelf_availability(
        t["fct_inventory"], t["dim_store"], t["dim_product"], t["fct_pos_sales"], "2025-11-02"
    ).collect()
    status = {r.store_id + r.brand: r.availability_status for r in rows}
    assert all(r.avg_daily_units is None and r.days_of_supply is None for r in rows)
    assert status.pop("TGT-1892Sunrise") == "OUT_OF_STOCK" and set(status.values()) == {"HEALTHY"}


def test_features(t):
    rows = (
        features.demand_features(t["pos_cleansed"])
        .where("store_key = 1 AND upc LIKE '%029'").orderBy("transaction_date").collect()
    )
    got = [(int(r.daily_units), r.had_promo, r.units_7d_avg, r.promo_running_count, r.wow_growth) for r in rows]
    assert got == [(120, 1, 120.0, 1, None), (95, 0, 107.5, 1, None)]
    assert [(r.day_of_week, r.month_num, r.is_weekend) for r in rows] == [(5, 11, 0), (6, 11, 1)]


def test_enriched_sales(t):
    enriched = bronze.enrich_pos(t["raw_pos"], t["dim_product"])
    assert enriched.count() == 15
    top = bronze.latest_sales(enriched, 4).collect()
    assert {str(r.sale_date) for r in top} == {"2024-11-02"} and len(top) == 4
    row = enriched.where("upc = '028000000050' AND retailer_code = 'TGT'").first()
    assert (float(row.kg_sold), row.revenue_per_kg) == (82.5, 198.0 / 82.5)


def test_quality_suite_passes(t):
    tables = {k: t[k] for k in ("fct_pos_sales", "fct_inventory", "fct_promotions", "dim_store", "dim_product")}
    report = run_checks(tables, MODEL_CHECKS).collect()
    assert len(report) == 15 and all(r.passed for r in report)
    assert sum(r.severity == "warn" for r in report) == 2
    assertions = run_checks(tables, ASSERTIONS).collect()
    assert len(assertions) == 6 and all(r.passed for r in assertions)


def test_product_versions_numbered(t):
    rows = silver.dim_product_versions(t["dim_product"]).collect()
    assert sorted(r.product_sk for r in rows) == list(range(1, len(PRODUCTS) + 1))


def test_seed_codes_fail_the_check_digit(t):
    assert t["dim_product"].where(check_digit_ok(F.col("upc"))).count() == 0
