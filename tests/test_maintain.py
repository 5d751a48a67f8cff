"""Tables that are kept up to date, against tables built from all rows."""

import glob
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators.deltas import Delta
from shelfline.operators.upsert import upsert
from shelfline.plans import gold, maintain, refresh
from shelfline.plans.build import merge_fact, silver_path
from shelfline.sources.tables import conform, read_table


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def sale_rows(spark, rows):
    """(key, retailer, store, upc, day, units, loaded)"""
    text = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], "k string, r string, s string, u string, d string, n string, l string")
    return conform(
        text.selectExpr(
            "k pos_sale_sk", "r retailer_code", "s store_key", "u upc", "d transaction_date", "n units_sold", "n revenue", "n revenue_usd", "n kg_sold",
            "'true' promo_flag", "'b' brand", "'c' category", "l _loaded_at",
        ),
        schemas.FCT_POS_SALES,
    )


def test_trailing_demand_over_ten_days(spark, tmp_path):
    """The window moves on by a day or two, rows come late, are replaced and leave; each time it equals the full scan."""
    fact, kept = str(tmp_path / "fact"), str(tmp_path / "demand")
    first = date(2024, 3, 1)
    as_of = first
    for step in range(10):
        as_of = as_of + timedelta(days=1 + step % 2)
        fresh = [(f"{step}-{i}", "R", i % 3, f"u{i % 4}", as_of - timedelta(days=(i * 5) % 33), None if i % 7 == 0 else i, f"{as_of} 0{i % 9}:00:00") for i in range(14)]
        again = []
        if step:
            old = read_table(spark, fact).where("pos_sale_sk IN ('0-1', '0-2', '0-3')").collect()
            again = [(r.pos_sale_sk, "R", r.store_key, r.upc, r.transaction_date, 100 + step, f"{as_of} 00:00:00") for r in old]
        done = upsert(spark, fact, sale_rows(spark, fresh + again), "pos_sale_sk", "transaction_date")
        assert done.replaced.count() == len(again)
        now = read_table(spark, fact)
        maintain.refresh_demand(spark, kept, now, maintain.sales_delta(done) if step else None, str(as_of))
        assert bag(maintain.demand(spark, kept, str(as_of))) == bag(gold.recent_demand(now, str(as_of)))
    with pytest.raises(ValueError):
        maintain.refresh_demand(spark, kept, now, maintain.sales_delta(done), str(as_of))


def test_daily_sums_grow_shrink_and_vanish(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = [("a", "R", 1, "u", "2024-01-01", 3, "2024-01-02"), ("b", "R", 1, "u", "2024-01-01", None, "2024-01-02"), ("c", "R", 1, "v", "2024-02-01", 4, "2024-01-02"), ("d", None, 1, "v", None, 4, "2024-01-02")]
    states = [rows, rows[:2] + [("c", "R", 1, "v", "2024-02-01", 9, "2024-01-03")], rows[1:2], rows]
    before = sale_rows(spark, [])
    for i, state in enumerate(states):
        after = sale_rows(spark, state)
        maintain.refresh_daily_sales(spark, path, Delta(after, before), str(i))
        from shelfline.operators.promo_days import daily_sales

        assert bag(maintain.daily_sales(spark, path)) == bag(daily_sales(after))
        before = after


def test_only_affected_months_are_written(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = sale_rows(spark, [(str(m), "R", 1, "u", f"2024-{m:02d}-05", 1, "2024-01-02") for m in range(1, 13)])
    maintain.refresh_daily_sales(spark, path, Delta(rows, rows.limit(0)), "0")
    before = glob.glob(f"{path}/*/*.parquet")
    late = sale_rows(spark, [("x", "R", 1, "u", "2024-07-09", 1, "2024-01-02")])
    maintain.refresh_daily_sales(spark, path, Delta(late, late.limit(0)), "1")
    assert {f for f in before if "2024-07-01" not in f} < set(glob.glob(f"{path}/*/*.parquet"))


def test_a_week_without_sales_loses_its_rows(spark, tmp_path):
    path = str(tmp_path / "weekly")
    names = ("retailer_name", "region", "store_name", "store_id")
    stores = spark.range(3).select(F.col("id").alias("store_key"), *[F.lit(n).alias(n) for n in names])
    products = spark.range(1).select(F.lit("u").alias("upc"), *[F.lit(c).alias(c) for c in ("brand", "category", "sub_category")], F.lit(1).cast("decimal(10,4)").alias("unit_weight_kg"), F.lit(True).alias("is_current"))
    rows = sale_rows(spark, [("a", "R", 1, "u", "2024-01-01", 3, "2024-01-02"), ("b", "R", 1, "u", "2024-01-10", 3, "2024-01-02")])
    refresh.refresh_weekly_demand(spark, path, rows, stores, products)
    left = rows.where("pos_sale_sk = 'b'")
    refresh.refresh_weekly_demand(spark, path, left, stores, products, rows.where("pos_sale_sk = 'a'"))
    assert [str(r.week_start) for r in read_table(spark, path).collect()] == ["2024-01-08"]


def fact_files(df):
    """Files that a scan of ``df`` opened."""
    return {r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()}


def test_undated_rows_lie_in_shares_and_the_mark_is_stored(spark, tmp_path, monkeypatch):
    from shelfline.operators import upsert as module
    from shelfline.plans import build

    root = str(tmp_path)
    rows = sale_rows(spark, [(f"k{i}", "R", 1, "u", None if i % 2 else "2024-01-05", i, "2024-01-06 00:00:00") for i in range(400)])
    merge_fact(spark, root, "fct_pos_sales", rows, lambda df: df)
    path = silver_path(root, "fct_pos_sales")
    shares = {f.split("undated_share=")[1].split("/")[0] for f in glob.glob(f"{path}/transaction_date=__HIVE*/*/*.parquet")}
    assert len(shares) > 30 and module.stored_mark(spark, path).startswith("2024-01-06")

    monkeypatch.setattr(build, "newer_than", lambda *args, **kwargs: pytest.fail("the target was scanned for its mark"))
    before = set(glob.glob(f"{path}/*/*/*.parquet"))
    late = sale_rows(spark, [("k7", "R", 1, "u", None, 1000, "2024-01-07 00:00:00"), ("k9", "R", 1, "u", None, 5, "2024-01-06 00:00:00")])
    done = merge_fact(spark, root, "fct_pos_sales", rows.unionByName(late), lambda df: df)
    assert done.written == 1 and [r.units_sold for r in done.replaced.collect()] == [7]
    after = set(glob.glob(f"{path}/*/*/*.parquet"))
    assert len(before - after) == 1 and len(after - before) == 1  # one share was rewritten
    touched = read_table(spark, path).where(module._in_partitions(done.increment, build.fact_parts("fct_pos_sales")))
    assert len(fact_files(touched)) == 1
    assert read_table(spark, path).where("pos_sale_sk = 'k7'").first().units_sold == 1000
    assert module.stored_mark(spark, path).startswith("2024-01-07")


def test_a_merge_that_died_keeps_its_mark(spark, tmp_path, monkeypatch):
    from shelfline.operators import upsert as module

    root = str(tmp_path)
    path = silver_path(root, "fct_pos_sales")
    rows = sale_rows(spark, [("a", "R", 1, "u", "2024-01-05", 1, "2024-01-06 00:00:00")])
    merge_fact(spark, root, "fct_pos_sales", rows, lambda df: df)
    late = sale_rows(spark, [("b", "R", 1, "u", "2024-01-05", 1, "2024-01-08 00:00:00"), ("c", "R", 1, "u", "2024-01-09", 1, "2024-01-07 00:00:00")])
    whole = module.write_clustered

    def dying(df, *args, **kwargs):
        whole(df.where("pos_sale_sk = 'b'"), *args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "write_clustered", dying)
    with pytest.raises(RuntimeError):
        merge_fact(spark, root, "fct_pos_sales", rows.unionByName(late), lambda df: df)
    monkeypatch.setattr(module, "write_clustered", whole)
    done = merge_fact(spark, root, "fct_pos_sales", rows.unionByName(late), lambda df: df)
    assert done.written == 0
    assert sorted(r.pos_sale_sk for r in read_table(spark, path).collect()) == ["a", "b", "c"]
    assert module.stored_mark(spark, path).startswith("2024-01-08")
