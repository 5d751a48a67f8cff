"""Dirty and edge-case rows through the jobs."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seeds import frame, landing, seed_tables
from shelfline import schemas
from shelfline.functions.measures import ratio
from shelfline.operators import lookups, promo_days, quality
from shelfline.plans import bronze, build, features, gold, silver, staging


@pytest.fixture(scope="module")
def ref(spark):
    t = seed_tables(spark)
    return {k: t[k] for k in ("dim_product", "dim_store", "dim_fx")}


def order(record, **over):
    row = dict(
        record_id=record, sales_org="1", distribution_channel="10", material_number="MAT-001", plant="P", customer_number="C",
        order_date="20241101", delivery_date="bad", order_qty="1.5", order_qty_uom="EA", net_value="10", currency="USD", order_type="Z",
    )
    return tuple({**row, **over}.values())


def test_rejects_carry_the_first_broken_rule(spark):
    rows = [
        order("ok"),
        order("date", order_date="20241399", order_qty="x"),
        order("qty", order_qty="x", net_value="x"),
        order("value", net_value="", material_number=None),
        order("material", material_number=None),
        order("null date", order_date=None),
    ]
    raw = landing(spark, schemas.RAW_ORDERS, rows)
    staged = bronze.stage_orders(raw, "2024-11-06 00:00:00").collect()
    rejected = {r.record_id: r for r in bronze.quarantine_orders(raw).collect()}
    assert [(r.record_id, r.order_qty, r.delivery_date) for r in staged] == [("ok", Decimal("1.500"), None)]
    assert str(staged[0]._staged_at) == "2024-11-06 00:00:00"
    assert {k: r.rejection_reason for k, r in rejected.items()} == {
        "date": "INVALID_DATE", "qty": "INVALID_QUANTITY", "value": "INVALID_NET_VALUE",
        "material": "NULL_MATERIAL", "null date": "INVALID_DATE",
    }
    assert (rejected["qty"].raw_order_qty, rejected["qty"].raw_net_value) == ("x", "x")
    assert len(staged) + len(rejected) == len(rows)


def sale(store="WMT-4201", upc="028000000012", day="2024-11-01", units="10", revenue="100.00", currency="USD", flag="N", code="WMT"):
    return (code, store, upc, day, units, revenue, currency, flag)


def pos(spark, *rows, loaded="2024-11-05 08:00:00"):
    return landing(spark, schemas.RAW_POS, list(rows), loaded=loaded)


def test_sales_kept_and_dropped(spark, ref):
    raw = pos(
        spark,
        sale(upc="02800000001"), sale(upc="028-000000012"), sale(upc="0028000000012"), sale(upc=None),
        sale(units="-1"), sale(units="N/A"), sale(units=None), sale(units="0"),
        sale(day="soon"), sale(revenue="bad"), sale(flag=None), sale(store="nowhere"), sale(code=" wmt"),
    )
    got = bronze.cleanse_pos(raw, ref["dim_store"], ref["dim_fx"]).collect()
    assert len(got) == 8
    assert sorted({r.upc for r in got}) == ["0028000000012", "028-000000012", "028000000012"]  # as sent
    assert sum(r.transaction_date is None for r in got) == 1
    assert sum(r.revenue is None and r.revenue_usd is None for r in got) == 1
    assert sum(r.promo_flag is None for r in got) == 1
    assert sum(r.store_key is None for r in got) == 2  # unknown store, untidy retailer code


def test_rates(spark, ref):
    raw = pos(
        spark, sale(currency="CAD", day="2024-11-30"), sale(currency="GBP", day="2024-10-31"),
        sale(currency="XXX"), sale(currency=None), sale(currency="EUR", revenue="0.33"),
    )
    staged = staging.stage_pos(raw)
    usd = [r.revenue_usd for r in silver.fct_pos_sales(staged, ref["dim_store"], ref["dim_product"], ref["dim_fx"]).collect()]
    cents = [r.revenue_usd for r in bronze.cleanse_pos(raw, ref["dim_store"], ref["dim_fx"]).collect()]
    assert sorted(map(float, usd)) == [0.35772, 72.1, 100.0, 100.0, 100.0]
    assert sorted(map(float, cents)) == [0.36, 72.1, 100.0, 100.0, 100.0]
    missing = gold.rows_without_rate(staged, ref["dim_fx"], "transaction_date", "currency_code", monthly=True)
    assert {r.currency_code: r.without_rate for r in missing.collect()} == {"CAD": 0, "GBP": 1, "XXX": 1, None: 1, "EUR": 0}


def test_order_rate_needs_the_exact_day(spark, ref):
    orders = bronze.stage_orders(
        landing(spark, schemas.RAW_ORDERS, [order("a", currency="CAD"), order("b", currency="CAD", order_date="20241102")])
    )
    rows = gold.conformed_sales(orders, ref["dim_product"], ref["dim_fx"]).orderBy("sales_order_id").collect()
    assert [float(r.net_value_usd) for r in rows] == [7.21, 10.0]


def test_product_version_bounds_are_inclusive(spark, ref):
    versions = frame(
        spark, schemas.DIM_PRODUCT,
        [
            ("MAT-001", "u", "old", "B", "C", "S", "1", 1, "1", "2024-01-01", "2024-10-31", "false"),
            ("MAT-001", "u", "new", "B", "C", "S", None, 1, "1", "2024-11-01", "9999-12-31", "true"),
        ],
    )
    days = ["20231231", "20240101", "20241031", "20241101"]
    orders = bronze.stage_orders(landing(spark, schemas.RAW_ORDERS, [order(d, order_date=d) for d in days]))
    rows = gold.conformed_sales(orders, versions, ref["dim_fx"]).orderBy("sales_order_id").collect()
    assert [r.product_name for r in rows] == [None, "old", "old", "new"]
    assert [r.material_number for r in rows] == [None, "MAT-001", "MAT-001", "MAT-001"]
    assert rows[-1].order_weight_kg is None  # unknown weight stays unknown in gold


def test_unknown_product_weighs_nothing_in_facts(spark, ref):
    fact = silver.fct_pos_sales(
        staging.stage_pos(pos(spark, sale(upc="999999999999"))), ref["dim_store"], ref["dim_product"], ref["dim_fx"]
    ).first()
    assert (fact.kg_sold, fact.brand) == (0, None)


def test_pipeline_quantity_needs_all_parts(spark, ref):
    rows = [("WMT", "WMT-4201", "u", "2024-11-01", "1", None, "2"), ("WMT", "WMT-4201", "u", "11/02/2024", "1", "0", "2"),
            ("WMT", "WMT-4201", "u", "", "1", "0", "2"), ("WMT", "WMT-4201", "u", "2024-11-01", "-1", "0", "2")]
    fact = silver.fct_inventory(staging.stage_inventory(landing(spark, schemas.RAW_INVENTORY, rows)), ref["dim_store"])
    assert sorted((r.total_pipeline_qty is None, str(r.snapshot_date)) for r in fact.collect()) == [
        (False, "2024-11-02"), (True, "2024-11-01"),
    ]


def test_keys_of_unknown_stores(spark, ref):
    staged = staging.stage_pos(pos(spark, sale(store="x"), sale(store="y")))
    args = (ref["dim_store"], ref["dim_product"], ref["dim_fx"])
    by_key = {r.pos_sale_sk for r in silver.fct_pos_sales(staged, *args).collect()}
    by_id = {r.pos_sale_sk for r in silver.fct_pos_sales(staged, *args, key_store="store_id").collect()}
    cleansed = bronze.cleanse_pos(pos(spark, sale(store="x")), ref["dim_store"], ref["dim_fx"])
    assert (len(by_key), len(by_id)) == (1, 2)
    assert silver.fct_pos_sales_from_bronze(cleansed, ref["dim_product"]).first().pos_sale_sk is None


def test_enrichment_accepts_twelve_digits_and_repairs_codes(spark, ref):
    raw = pos(
        spark, sale(code=" wmt ", upc="028-000000012"), sale(upc="0028000000012"), sale(units="0"),
        sale(revenue="-1"), sale(code="KRO", store=" KRO-0531", day="11/01/2024"),
    )
    rows = bronze.enrich_pos(raw, ref["dim_product"]).collect()
    assert sorted(r.retailer_code for r in rows) == ["KRO", "WMT", "WMT"]
    assert {r.upc for r in rows} == {"028000000012"} and {r.store_id for r in rows} == {"WMT-4201", "KRO-0531"}
    assert {r.revenue_per_kg for r in rows if r.units_sold == 0} == {None}
    with pytest.raises(PySparkException):
        bronze.enrich_pos(pos(spark, sale(units="N/A")), ref["dim_product"]).collect()
    with pytest.raises(PySparkException):
        bronze.enrich_pos(pos(spark, sale(day="20241101")), ref["dim_product"]).collect()


def test_latest_sales_puts_unknown_dates_first(spark, ref):
    enriched = bronze.enrich_pos(pos(spark, sale(), sale(day="2024-11-02"), sale(day=None)), ref["dim_product"])
    assert [str(r.sale_date) for r in bronze.latest_sales(enriched).collect()] == ["None", "2024-11-02", "2024-11-01"]


def test_audit_looks_at_load_time(spark, ref):
    old = pos(spark, sale(), loaded="2024-11-05 06:59:59")
    new = pos(spark, sale(), sale(store="?"), sale(day="2024-11-06"), sale(revenue="-2"), loaded="2024-11-05 07:00:00")
    cleansed = bronze.cleanse_pos(old.unionByName(new), ref["dim_store"], ref["dim_fx"])
    row = bronze.pos_quality_audit(cleansed, "2024-11-05 08:00:00").first()
    assert tuple(row)[1:] == (4, 1, 1, 1)
    assert bronze.pos_quality_audit(cleansed, "2030-01-01 00:00:00").first().total_rows == 0


def clean(spark, rows):
    return frame(spark, schemas.POS_CLEANSED, [("WMT", *r) for r in rows])


def test_windows_count_rows_not_days(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-05", "2024-02-01", "2024-02-02", "2024-03-01", "2024-03-02", "2024-06-01"]
    rows = [(1, "u", d, i + 1, 10, "USD", 10, "true" if i % 2 else "false") for i, d in enumerate(days)]
    got = features.demand_features(clean(spark, rows)).orderBy("transaction_date").collect()
    last = got[-1]
    assert last.units_7d_avg == sum(range(2, 9)) / 7 and last.units_28d_avg == sum(range(1, 9)) / 8
    assert last.wow_growth == 7.0 and [r.wow_growth for r in got[:7]] == [None] * 7
    assert last.promo_running_count == 4 and [r.had_promo for r in got] == [0, 1] * 4


def test_growth_from_zero_is_unknown(spark):
    rows = [(1, "u", f"2024-01-0{i}", 0 if i == 1 else 5, 1, "USD", 1, None) for i in range(1, 9)]
    got = features.demand_features(clean(spark, rows)).orderBy("transaction_date").collect()[-1]
    assert (got.wow_growth, got.had_promo, got.promo_running_count) == (None, None, None)


def test_weekend_numbering(spark):
    week = [(1, "u", f"2024-11-{d:02d}", 1, 1, "USD", 1, None) for d in range(4, 11)]  # Monday .. Sunday
    def flags(**how):
        rows = features.demand_features(clean(spark, week), **how).orderBy("transaction_date").collect()
        return [r.day_of_week for r in rows], [r.is_weekend for r in rows]
    assert flags() == ([1, 2, 3, 4, 5, 6, 0], [0, 0, 0, 0, 0, 1, 0])
    assert flags(week_start=1) == ([1, 2, 3, 4, 5, 6, 7], [0, 0, 0, 0, 0, 1, 1])


def test_days_since_stockout(spark):
    days = (1, 5, 9, 10, 11, 12, 13, 14)
    sold = clean(spark, [(s, "u", f"2024-01-{d:02d}", d, 1, "USD", 1, None) for d in days for s in (1, None)])
    stock = frame(spark, schemas.INVENTORY_CLEANSED, [("WMT", 1, "u", "2024-01-03", 0), ("WMT", 1, "u", "2024-01-05", 0), ("WMT", 1, "u", "2024-01-08", 2), ("WMT", None, "u", "2024-01-02", 0), ("WMT", 1, "u", "2024-01-05", 0), ("WMT", 9, "u", "2024-01-02", 0)])
    both = features.demand_features_with_stockouts(sold, stock)
    rows = both.where("store_key = 1").orderBy("transaction_date").collect()
    assert [r.days_since_stockout for r in rows] == [None, 0, 4, 5, 6, 7, 8, 9]
    assert {r.days_since_stockout for r in both.where("store_key IS NULL").collect()} == {None}
    plain = features.demand_features(sold)  # stock-out days change no other feature
    assert sorted(map(str, both.drop("days_since_stockout").select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def promo_row(pid, start, end, material="MAT-001", retailer="WMT", spend="100"):
    return (pid, "n", retailer, material, start, end, "TPR", "10", spend)


@pytest.fixture(scope="module")
def lift_tables(spark, ref):
    promos = silver.fct_promotions(
        staging.stage_promo(landing(spark, schemas.RAW_PROMO, [
            promo_row("P1", "2024-11-01", "2024-11-02"),
            promo_row("P2", "2024-11-10", "9999-12-31", material="MAT-002"),
            promo_row("P3", "2024-11-20", "2024-11-19"),
            promo_row("P4", "later", "2024-11-19"),
            promo_row("P5", "2024-11-01", "2024-11-30", retailer="TGT", spend="0"),
        ])),
        ref["dim_product"],
    )
    rows = [sale(day="2024-11-01", units="20"), sale(day="2024-11-05", units="10"), sale(day="2024-11-06", units="30"),
            sale(day="2024-11-06", units="50", upc="028000000029"), sale(day="2024-11-12", units="90"),
            sale(day="2024-11-12", units="8", upc="028000000029"), sale(day=None, units="70"),
            sale(code="TGT", store="TGT-1892", day="20241103", units="5")]
    fact = silver.fct_pos_sales(staging.stage_pos(pos(spark, *rows)), ref["dim_store"], ref["dim_product"], ref["dim_fx"])
    return promos, fact


def test_lift_folds_the_products_of_the_retailer(ref, lift_tables):
    promos, fact = lift_tables
    rows = gold.promo_lift_by_retailer(promos, ref["dim_product"], fact).collect()
    got = {r.promo_id: (r.products, r.baseline_daily_kg, r.lift_pct) for r in rows}
    # MAT-001 off promotion: 10, 30 and the undated 70 units at 0.2 kg; MAT-002: 50 at 0.0415.
    a, b = (10 + 30 + 70) * 0.2 / 3, 50 * 0.0415
    daily = {r.promo_id: r.promo_daily_kg for r in rows}
    assert got["P1"] == (2, round((a + b) / 2, 6), round(((daily["P1"] - a) / a + (daily["P1"] - b) / b) / 2, 6))
    assert got["P2"][:2] == got["P1"][:2] and got["P5"] == (0, None, None)


def test_lift_measures(ref, lift_tables):
    promos, fact = lift_tables
    row = {r.promo_id: r for r in gold.promo_lift(promos, ref["dim_product"], fact).collect()}
    base = 110 * 0.2 / 3
    p1 = row["P1"]
    assert (p1.promo_days, float(p1.promo_kg), p1.promo_daily_kg) == (2, 4.0, 2.0)
    assert p1.lift_pct == pytest.approx((2.0 - base) / base)
    assert p1.incremental_revenue_est == pytest.approx(100.0 - base * 2 * 32.5)
    assert p1.promo_roi == pytest.approx(p1.incremental_revenue_est / 100)
    assert (row["P5"].baseline_daily_kg, row["P5"].promo_roi) == (None, None)
    assert set(row) == {"P1", "P2", "P5"}


def test_covered_days_of_open_ended_promos(lift_tables):
    days = promo_days.covered_days(lift_tables[0]).where("retailer_code = 'WMT' AND transaction_date < '2024-11-13'")
    assert sorted(r.transaction_date.day for r in days.collect()) == [1, 2, 10, 11, 12]


def test_stored_daily_sales_give_the_same_lift(ref, lift_tables):
    promos, fact = lift_tables
    daily = promo_days.daily_sales(fact)
    a = gold.promo_lift(promos, ref["dim_product"], fact)
    b = gold.promo_lift(promos, ref["dim_product"], daily=daily)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_brand_price_is_the_lowest_material(ref):
    prices = {r.brand: float(r.brand_price_per_kg) for r in lookups.price_by_brand(ref["dim_product"]).collect()}
    assert prices == {"Sunrise": 32.5, "ChocoCrunch": 18.0, "PetPrime": 6.8, "QuickBite": 4.2, "CrystalSpring": 2.4}


def test_status_limits(spark):
    supply = [(0, 0.0), (1, 2.99), (1, 3.0), (1, 6.99), (1, 7.0), (1, 28.0), (1, 28.01), (1, None), (0, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(supply)], "i int, q int, d double")
    got = [r[0] for r in df.orderBy("i").select(gold.stock_status(F.col("q"), F.col("d"))).collect()]
    assert got == ["OUT_OF_STOCK", "CRITICAL", "LOW", "LOW", "HEALTHY", "HEALTHY", "OVERSTOCK", "HEALTHY", "OUT_OF_STOCK"]


def test_weeks_without_days(spark, ref):
    fact = silver.fct_pos_sales(staging.stage_pos(pos(spark, sale(day="?"))), ref["dim_store"], ref["dim_product"], ref["dim_fx"])
    row = gold.weekly_store_demand(fact, ref["dim_store"], ref["dim_product"]).first()
    assert (row.week_start, row.selling_days, row.avg_daily_kg) == (None, 0, None)


def test_duplicate_product_codes_multiply_rows_and_show_in_the_check(spark, ref):
    doubled = ref["dim_product"].unionByName(ref["dim_product"].where("material_number = 'MAT-001'"))
    fact = silver.fct_pos_sales(staging.stage_pos(pos(spark, sale())), ref["dim_store"], doubled, ref["dim_fx"])
    assert fact.count() == 2
    assert [(r.rows) for r in quality.duplicates(fact, "pos_sale_sk").collect()] == [2]


def test_checks_report_what_they_find(spark, ref):
    fact = frame(spark, schemas.FCT_PROMOTIONS, [("P1", "n", "W", "MAT-001", "u", "2024-01-02", "2024-01-01"), ("P1", "n", "W", None, "u", None, None), ("P2", "n", "W", "MAT-X", "u", "2024-01-01", "2024-01-01"), (None, "n", "W", "MAT-X", "u", "2024-01-01", "2024-01-01")])
    checks = [c for c in (*quality.MODEL_CHECKS, *quality.ASSERTIONS) if c.table == "fct_promotions"]
    report = quality.run_checks({"fct_promotions": fact, "dim_product": ref["dim_product"]}, checks)
    assert {r.check_name.removeprefix("fct_promotions."): r.violations for r in report.collect()} == {
        "promo_id.unique": 1, "promo_id.not_null": 1, "start_date.not_null": 1, "material_number.not_null": 1,
        "material_number.reference": 2, "start_date.ordered": 1, "material_number.reference_or_null": 3,
    }
    assert quality.below(fact.select(F.lit(-1).alias("q")), "q").count() == 4
    assert quality.missing(fact, "promo_id").count() == 1


def test_division_by_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_rejects_and_accepted_rows_add_up(spark):
    rows = [sale(units="1234567890123456789"), sale(units="N/A"), sale(units="-1"), sale(units=None), sale(upc="12"), sale(upc=None), sale(), sale(day="bad")]
    raw = pos(spark, *rows)
    reasons = [r.rejection_reason for r in bronze.rejected_pos(raw).collect()]
    assert sorted(reasons) == sorted(["UNITS_TOO_LARGE", "INVALID_UNITS", "NEGATIVE_UNITS", "INVALID_UNITS", "INVALID_UPC", "INVALID_UPC"])
    assert staging.stage_pos(raw).count() + len(reasons) == len(rows)
    assert bronze.readable_pos(raw).count() + bronze.unreadable_pos(raw).count() == len(rows)


def test_date_layouts_are_arguments(spark):
    raw = pos(spark, sale(code="NEW", day="05.11.2024"), sale(code="OLD", day="2024/11/05"))
    got = [str(r.transaction_date) for r in staging.stage_pos(raw, {"NEW": "dd.MM.yyyy"}, ("yyyy/MM/dd",)).collect()]
    assert got == ["2024-11-05"] * 2


def test_an_error_stops_and_a_warning_does_not(spark):
    report = spark.createDataFrame([("a", "warn", 3, False, "WARN"), ("b", "error", 0, True, "PASS")], "check_name string, severity string, violations long, passed boolean, status string")
    quality.stop_on_errors(report)
    with pytest.raises(quality.ChecksFailed, match="c: 2"):
        quality.stop_on_errors(report.unionByName(report.limit(1).selectExpr("'c' check_name", "'error' severity", "2L violations", "false passed", "'ERROR' status")))


def test_a_build_stops_on_errors(spark, ref, tmp_path):
    """A sale without a date is an error by the checks."""
    feeds = {
        "raw_pos": pos(spark, sale(day="bad")),
        **{n: seed_tables(spark)[n] for n in ("raw_inventory", "raw_promo")},
    }
    with pytest.raises(quality.ChecksFailed, match="fct_pos_sales.transaction_date.not_null: 1"):
        build.build_silver(spark, feeds, ref, str(tmp_path / "stop"))
    report = build.build_silver(spark, feeds, ref, str(tmp_path / "go"), stop=False)
    assert {r.status for r in report.collect()} == {"PASS", "ERROR"}


def test_an_order_without_an_id_is_rejected(spark):
    raw = landing(spark, schemas.RAW_ORDERS, [order("ok"), order(None)])
    assert [r.rejection_reason for r in bronze.quarantine_orders(raw).collect()] == ["NULL_RECORD_ID"]
    assert bronze.stage_orders(raw).count() == 1
