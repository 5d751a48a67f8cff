"""Micro-batch ingest: offsets, two sinks, replays, follow-up jobs."""

import shutil

import pytest
from pyspark.sql import functions as F

from seeds import ORDERS, POS, INVENTORY, landing, seed_tables
from shelfline import schemas
from shelfline.operators.upsert import upsert
from shelfline.plans import bronze, gold, silver, staging
from shelfline.plans.refresh import refresh_on_change, refresh_weekly_demand
from shelfline.sources import tables
from shelfline.sources.raw import stream_feed
from shelfline.streaming import ingest

RUN = "2024-11-06 00:00:00"


@pytest.fixture
def dirs(tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "bronze")


def drop(spark, path, schema, rows):
    landing(spark, schema, rows).coalesce(1).write.mode("append").parquet(path)


def bad_order():
    return ("BAD", *ORDERS[0][1:6], "2024-11-01", *ORDERS[0][7:])


def counts(spark, root):
    return tuple(ingest.read_batches(spark, root, t).count() for t in ("orders_staged", "orders_rejected"))


def test_each_file_is_taken_in_once(spark, dirs):
    land, root = dirs
    drop(spark, land, schemas.RAW_ORDERS, [*ORDERS[:4], bad_order()])  # there before the stream starts
    ingest.ingest_orders(spark, land, root, RUN).awaitTermination()
    assert counts(spark, root) == (4, 1)
    query = ingest.ingest_orders(spark, land, root, RUN)
    query.awaitTermination()
    assert query.lastProgress is None or query.lastProgress["numInputRows"] == 0
    assert spark.read.parquet(f"{root}/ingest_log/orders").count() == 1  # nothing new, no batch
    drop(spark, land, schemas.RAW_ORDERS, ORDERS[4:])
    ingest.ingest_orders(spark, land, root, RUN).awaitTermination()
    assert counts(spark, root) == (8, 1)
    messages = [r.message for r in spark.read.parquet(f"{root}/ingest_log/orders").orderBy("batch").collect()]
    assert messages == ["Staged: 4 rows. Rejected: 1 rows.", "Staged: 4 rows. Rejected: 0 rows."]
    whole = bronze.stage_orders(landing(spark, schemas.RAW_ORDERS, ORDERS), RUN)
    got = ingest.read_batches(spark, root, "orders_staged")
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_a_repeated_batch_replaces_its_rows(spark, dirs):
    land, root = dirs
    drop(spark, land, schemas.RAW_ORDERS, [*ORDERS, bad_order()])
    ingest.ingest_orders(spark, land, root, RUN).awaitTermination()
    shutil.rmtree(f"{root}/_offsets/orders/commits")  # as if the driver died before the commit
    ingest.ingest_orders(spark, land, root, RUN).awaitTermination()
    assert counts(spark, root) == (8, 1)


def test_sales_are_audited_after_each_batch(spark, dirs):
    land, root = dirs
    t = seed_tables(spark)
    drop(spark, land, schemas.RAW_POS, POS[:10])
    seen = []
    run = lambda: ingest.ingest_pos(
        spark, land, root, t["dim_store"], t["dim_fx"], "2024-11-05 08:30:00", after=lambda df: seen.append(df.count())
    ).awaitTermination()
    run()
    drop(spark, land, schemas.RAW_POS, POS[10:])
    run()
    log = spark.read.parquet(f"{root}/pos_quality_log").orderBy("batch").collect()
    assert [r.total_rows for r in log] == [10, 15] and seen == [10, 5]
    want = bronze.cleanse_pos(t["raw_pos"], t["dim_store"], t["dim_fx"])
    got = ingest.read_batches(spark, root, "pos_cleansed")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_repeated_sales_batch_replaces_its_rows(spark, dirs):
    land, root = dirs
    t = seed_tables(spark)
    drop(spark, land, schemas.RAW_POS, POS)
    for _ in range(2):
        ingest.ingest_pos(spark, land, root, t["dim_store"], t["dim_fx"], "2024-11-05 08:30:00").awaitTermination()
        shutil.rmtree(f"{root}/_offsets/pos/commits")
    assert ingest.read_batches(spark, root, "pos_cleansed").count() == 15
    assert [r.total_rows for r in spark.read.parquet(f"{root}/pos_quality_log").collect()] == [15]


def test_audits_open_the_folders_that_the_manifest_names(spark, dirs):
    """Batches whose loads ended before the audited hour are in no later manifest; their folders may even be gone."""
    land, root = dirs
    t = seed_tables(spark)
    early = landing(spark, schemas.RAW_POS, POS[:10]).withColumn("_loaded_at", F.lit("2024-11-01 08:00:00").cast("timestamp_ntz"))
    early.coalesce(1).write.mode("append").parquet(land)
    run = lambda: ingest.ingest_pos(spark, land, root, t["dim_store"], t["dim_fx"], "2024-11-05 08:30:00").awaitTermination()
    run()
    assert ingest.read_manifest(spark, root, 0).count() == 0
    shutil.rmtree(f"{root}/pos_cleansed/batch=0")
    drop(spark, land, schemas.RAW_POS, POS[10:])
    run()
    (entry,) = ingest.read_manifest(spark, root, 1).collect()
    assert (entry.folder, entry.rows) == ("pos_cleansed/batch=1", 5) and entry.first_load <= entry.last_load
    assert [r.total_rows for r in spark.read.parquet(f"{root}/pos_quality_log").orderBy("batch").collect()] == [0, 5]


def test_plain_csv_files(spark, dirs):
    land, root = dirs
    payload = landing(spark, schemas.RAW_ORDERS, [*ORDERS, bad_order()]).drop(*schemas.LINEAGE)
    payload.coalesce(1).write.csv(land, header=True)
    ingest.ingest_orders(spark, land, root, RUN, fmt="csv", plain=True, header="true").awaitTermination()
    assert counts(spark, root) == (8, 1)
    staged = ingest.read_batches(spark, root, "orders_staged")
    assert staged.where("_source_file LIKE '%.csv' AND _loaded_at IS NOT NULL").count() == 8


def test_polling(spark, dirs):
    land, root = dirs
    drop(spark, land, schemas.RAW_ORDERS, ORDERS[:3])
    query = ingest.ingest_orders(spark, land, root, RUN, processingTime="1 second")
    try:
        query.processAllAvailable()
        drop(spark, land, schemas.RAW_ORDERS, ORDERS[3:])
        query.processAllAvailable()
    finally:
        query.stop()
    assert counts(spark, root) == (8, 0)


def test_stock_snapshots(spark, dirs):
    land, root = dirs
    drop(spark, land, schemas.RAW_INVENTORY, INVENTORY)
    ingest.ingest_inventory(spark, land, root, seed_tables(spark)["dim_store"]).awaitTermination()
    assert ingest.read_batches(spark, root, "inventory_cleansed").count() == 8


def test_gold_follows_the_stream(spark, tmp_path):
    """New sales reach the fact, then only their weeks are rebuilt in the weekly table."""
    land, fact, weekly = (str(tmp_path / n) for n in ("landing", "fact", "weekly"))
    t = seed_tables(spark)
    dims = (t["dim_store"], t["dim_product"], t["dim_fx"])
    weeks = []

    def job(batch):
        rows = silver.fct_pos_sales(staging.stage_pos(batch), *dims)
        done = upsert(spark, fact, rows, "pos_sale_sk", "transaction_date")
        refresh_weekly_demand(spark, weekly, tables.read_table(spark, fact), dims[0], dims[1], done.increment)
        weeks.append(done.written)

    def run():
        refresh_on_change(stream_feed(spark, "raw_pos", land), job, str(tmp_path / "offsets")).awaitTermination()

    drop(spark, land, schemas.RAW_POS, POS)
    run()
    import glob

    old = glob.glob(f"{weekly}/week_start=2024-10-28/*.parquet")
    later = ("WMT", "WMT-4201", "028000000012", "2024-11-12", "7", "1.00", "USD", "N")
    drop(spark, land, schemas.RAW_POS, [later])
    run()
    assert glob.glob(f"{weekly}/week_start=2024-10-28/*.parquet") == old and weeks == [15, 1]
    whole = gold.weekly_store_demand(tables.read_table(spark, fact), dims[0], dims[1])
    got = tables.read_table(spark, weekly).select(*whole.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    assert got.agg(F.sum("total_units")).first()[0] == 927


def test_reference_tables_are_read_for_each_batch(spark, dirs, tmp_path):
    """A store and a rate that come between two batches, by overwriting the tables, count for the second."""
    land, root = dirs
    t = seed_tables(spark)
    paths = [str(tmp_path / n) for n in ("store", "fx")]

    def write(stores, fx):
        stores.write.mode("overwrite").parquet(paths[0])
        fx.write.mode("overwrite").parquet(paths[1])

    known = t["dim_store"].where("store_id <> 'WMT-4201'")
    write(known, t["dim_fx"].where("false"))
    sale = ("WMT", "WMT-4201", "028000000012", "2024-11-04", "7", "1.00", "EUR", "N")
    drop(spark, land, schemas.RAW_POS, [sale])
    query = ingest.ingest_pos(spark, land, root, *paths, "2024-11-05 08:30:00", processingTime="1 second")
    try:
        query.processAllAvailable()
        write(t["dim_store"], t["dim_fx"].where("currency_code = 'USD'").limit(1).selectExpr("date'2024-11-01' rate_date", "'EUR' currency_code", "cast(2 as decimal(18,6)) rate_to_usd"))
        drop(spark, land, schemas.RAW_POS, [sale])
        query.processAllAvailable()
    finally:
        query.stop()
    got = sorted((r.store_key is not None, float(r.revenue_usd)) for r in ingest.read_batches(spark, root, "pos_cleansed").collect())
    assert got == [(False, 1.0), (True, 2.0)]
