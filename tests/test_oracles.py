"""Every named query against its SQL counterpart, row by row."""

import re

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from shelfline.catalog.oracles import oracles
from shelfline.catalog.queries import COVERS, REGISTRY

# The retail queries; the corpus operators have their own tests.
QUERIES, ORACLES = {name: entry_point.queries()[name] for name in REGISTRY}, oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_each_survey_id_has_a_query():
    """S7, literal rows, exists as test input only."""
    ids = {
        *(f"S{i}" for i in range(1, 14) if i != 7), *(f"P{i}" for i in range(1, 13)), *(f"F{i}" for i in range(1, 10)),
        *(f"J{i}" for i in range(1, 15)), *(f"A{i}" for i in range(1, 12)), *(f"W{i}" for i in range(1, 6)), "L1", "L2",
        *(f"B{i}" for i in range(1, 7)), *(f"V{i}" for i in range(1, 4)), *(f"M{i}" for i in range(1, 6)),
        *(f"G{i}" for i in range(1, 5)), "K1a", "K1b", "K2", "I1", "I2", "I3", *(f"C{i}" for i in range(1, 7)),
        "Q-U", "Q-N", "Q-R", "Q-F", "Q-O", "Q-S", "X1", "X2", "X3", "X4",
    }
    assert {i for covered in COVERS.values() for i in covered} == ids


# Every row against every row, or rows through Python: none of it in any plan.
FORBIDDEN = re.compile("CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas|FlatMapGroups")


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert not FORBIDDEN.search(df._jdf.queryExecution().executedPlan().toString())
    assert differences(df, con, ORACLES[name]) == []


SORT_MERGE = (
    "fct_pos_sales", "fct_inventory", "conformed_sales", "weekly_store_demand", "promo_lift", "promo_lift_by_retailer",
    "on_shelf_availability", "demand_features", "order_changes", "new_product_versions", "quality_report",
    "incremental_pos_sales", "cleanse_pos", "orphan_upcs",
)


@pytest.mark.parametrize("name", SORT_MERGE)
def test_query_with_tables_too_large_to_broadcast(spark, con, sf_dir, name):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
