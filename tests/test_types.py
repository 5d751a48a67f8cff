"""Types of results as the jobs make them, before they are cast for comparison with other engines."""

import pytest
from pyspark.sql import types as T

from shelfline import schemas
from shelfline.catalog.queries import REGISTRY
from shelfline.catalog.tables import Tables

DECLARED = {
    "raw_orders": schemas.RAW_ORDERS, "raw_pos": schemas.RAW_POS, "raw_inventory": schemas.RAW_INVENTORY, "raw_promo": schemas.RAW_PROMO,
    "dim_product": schemas.DIM_PRODUCT, "dim_store": schemas.DIM_STORE, "dim_fx": schemas.DIM_FX, "append_orders": schemas.ORDERS_STAGED,
    "stage_orders": schemas.ORDERS_STAGED, "quarantine_orders": schemas.ORDERS_REJECTED, "cleanse_pos": schemas.POS_CLEANSED,
    "cleanse_inventory": schemas.INVENTORY_CLEANSED, "pos_quality_audit": schemas.POS_QUALITY_LOG, "fct_pos_sales_from_bronze": schemas.FCT_POS_SALES,
    "fct_inventory_from_bronze": schemas.FCT_INVENTORY, "fct_promotions_loaded": schemas.FCT_PROMOTIONS, "dim_product_versions": schemas.DIM_PRODUCT_VERSIONS,
    "lasting_product_numbers": schemas.DIM_PRODUCT_VERSIONS, "stream_pos": schemas.POS_CLEANSED, "stream_inventory": schemas.INVENTORY_CLEANSED,
    "stream_orders": schemas.ORDERS_STAGED, "keyless_sales": schemas.FCT_POS_SALES,
}
# Of the gold tables and the features, which have no declaration of their own.
KINDS = {
    "weekly_store_demand": {"week_start": T.DateType, "total_units": T.DecimalType, "total_kg": T.DecimalType, "total_revenue_usd": T.DecimalType, "selling_days": T.LongType, "avg_daily_kg": T.DoubleType},
    "promo_lift": {"start_date": T.DateType, "end_date": T.DateType, "promo_days": T.IntegerType, "promo_kg": T.DecimalType, "lift_pct": T.DoubleType, "promo_revenue": T.DecimalType, "promo_roi": T.DoubleType},
    "on_shelf_availability": {"snapshot_date": T.DateType, "on_hand_qty": T.DecimalType, "avg_daily_units": T.DoubleType, "days_of_supply": T.DoubleType, "availability_status": T.StringType},
    "conformed_sales": {"order_date": T.DateType, "delivery_date": T.DateType, "order_qty": T.DecimalType, "order_weight_kg": T.DecimalType, "net_value_usd": T.DecimalType, "source_timestamp": T.TimestampNTZType},
    "demand_features": {"transaction_date": T.DateType, "daily_units": T.DecimalType, "had_promo": T.IntegerType, "units_7d_avg": T.DoubleType, "wow_growth": T.DoubleType, "day_of_week": T.IntegerType},
    "quality_report": {"violations": T.LongType, "passed": T.BooleanType},
    "promo_flags": {"is_promo": T.BooleanType},
}


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return Tables(spark, sf_dir)


@pytest.mark.parametrize("name", DECLARED)
def test_declared_types(given, name):
    found = {f.name: f.dataType for f in REGISTRY[name](given).schema.fields}
    assert found == {f.name: f.dataType for f in DECLARED[name].fields}


@pytest.mark.parametrize("name", KINDS)
def test_kinds_of_measures(given, name):
    found = {f.name: type(f.dataType) for f in REGISTRY[name](given).schema.fields}
    assert {c: found.get(c) for c in KINDS[name]} == KINDS[name]


@pytest.mark.parametrize("kept, built", [("refreshed_promo_lift", "promo_lift"), ("refreshed_availability", "on_shelf_availability"), ("refreshed_conformed_sales", "conformed_sales"), ("refreshed_weekly_demand_of_new_master", "weekly_store_demand")])
def test_kept_tables_have_the_types_of_built_ones(given, kept, built):
    assert {f.name: f.dataType for f in REGISTRY[kept](given).schema.fields} == {f.name: f.dataType for f in REGISTRY[built](given).schema.fields}
