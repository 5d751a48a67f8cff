"""Tables that are small as files and large in memory are not broadcast."""

from functools import partial

from pyspark.sql import functions as F

from shelfline.catalog.tables import Tables
from shelfline.operators import lookups
from shelfline.operators.changes import snapshot_diff
from shelfline.operators.deltas import Delta
from shelfline.plans import gold, maintain
from shelfline.sources.tables import stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def packed(spark, rows):
    """Rows of about 150 bytes that take a few bytes as files."""
    return stored(spark.range(rows, numPartitions=2).select("id", F.repeat(F.lit("x"), 100).alias("text")), "packed")


def test_a_table_beyond_the_limit_is_not_broadcast_by_the_size_of_its_files(spark):
    fact = spark.range(50_000).withColumnRenamed("id", "k")
    table = packed(spark, 20_000)
    for limit, join in ((1 << 30, "BroadcastHashJoin"), (1 << 20, "SortMergeJoin")):
        assert join in plan(fact.join(lookups.if_small(table, limit), F.col("k") == F.col("id"), "left"))


def test_signs_of_changed_keys_are_not_broadcast(spark):
    old = packed(spark, 20_000)
    changed = snapshot_diff(old, old.withColumn("text", F.concat("text", F.lit("y"))), ["id"])
    assert "Broadcast" not in plan(changed)
    assert changed.where("is_update").count() == 40_000
    # Without ``is_update`` nothing is joined.
    assert "Join" not in plan(changed.drop("is_update"))


def test_null_parts_of_keys_meet(spark):
    schema = "k string, j string, v int"
    old = spark.createDataFrame([(None, None, 1), (None, "x", 2), ("a", None, 3), ("b", "y", 4)], schema)
    new = spark.createDataFrame([(None, None, 5), (None, "x", 2), ("a", None, 6), ("c", "y", 4)], schema)
    got = {(r.change, r.is_update, r.k, r.j, r.v) for r in snapshot_diff(old, new, ["k", "j"]).collect()}
    assert got == {
        ("DELETE", True, None, None, 1), ("INSERT", True, None, None, 5), ("DELETE", True, "a", None, 3), ("INSERT", True, "a", None, 6),
        ("DELETE", False, "b", "y", 4), ("INSERT", False, "c", "y", 4),
    }


def test_a_large_product_master_is_not_broadcast_to_orders(spark, sf_dir, monkeypatch, tmp_path):
    tables, seen, conformed = Tables(spark, sf_dir), [], gold.conformed_sales

    def noted(orders, products, fx):
        found = conformed(orders, products, fx)
        seen.append(plan(found))
        return found

    monkeypatch.setattr(maintain.gold, "conformed_sales", noted)
    monkeypatch.setattr(maintain, "if_small", partial(lookups.if_small, limit=0))
    orders, products, rates = tables.orders_staged, tables.dim_product, tables.dim_fx
    dearer = products.withColumn("unit_weight_kg", (F.col("unit_weight_kg") * 2).cast("decimal(10,4)"))
    nothing = Delta(orders.limit(0), orders.limit(0))
    path = str(tmp_path / "conformed_sales")
    maintain.refresh_conformed_sales(spark, path, orders, nothing, maintain.same(products), maintain.same(rates), "1")
    maintain.refresh_conformed_sales(spark, path, orders, nothing, maintain.Versions(products, dearer), maintain.same(rates), "2")
    # Frames without rows aren't joined.
    assert not any("BroadcastHashJoin [material_number" in p for p in seen) and sum("SortMergeJoin [material_number" in p for p in seen) == 3
    want = conformed(orders, dearer, rates)
    got = spark.read.parquet(path).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
