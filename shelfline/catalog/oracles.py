"""The same results in plain SQL for DuckDB, over the same tables.

Written from the definitions, not from the Spark plans: range joins stay range joins, latest rows
come from rankings, numbers from one ranking of the table, averages are taken over the rows themselves.
"""

from __future__ import annotations

import re

from pyspark.sql.types import BooleanType, DecimalType, FractionalType, IntegralType, StructType

from shelfline import schemas
from shelfline.catalog.feeds import FEEDS
from shelfline.catalog.tables import AS_OF, AUDIT_AT, FIRST_LOAD_END, RUN_TIME
from shelfline.functions.keys import NULL_PART

# What the columns of a result are cast to.
TEXT, WHOLE, NUMBER = "varchar", "bigint", "double"


def _columns(schema: StructType) -> dict[str, str]:
    """The columns of a declared table in these types; flags are whole numbers, dates and times are text."""
    kinds = ((DecimalType, NUMBER), (FractionalType, NUMBER), (IntegralType, WHOLE), (BooleanType, WHOLE))
    return {f.name: next((kind for t, kind in kinds if isinstance(f.dataType, t)), TEXT) for f in schema.fields}


def _date(text: str, layout: str) -> str:
    return f"cast(try_strptime({text}, '{layout}') as date)"


def _auto_date(text: str) -> str:
    return f"coalesce({_date(text, '%Y-%m-%d')}, {_date(text, '%m/%d/%Y')})"


def _sale_date(code: str = "retailer_code", text: str = "transaction_date") -> str:
    return (
        f"case {code} when 'WMT' then {_date(text, '%Y-%m-%d')} when 'KRO' then {_date(text, '%m/%d/%Y')}"
        f" when 'TGT' then {_date(text, '%Y%m%d')} else {_auto_date(text)} end"
    )


def _dec(text: str, p: int, s: int) -> str:
    return f"try_cast({text} as decimal({p},{s}))"


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '', 'g')"


def _hashed(*parts: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(cast({p} as varchar), '{NULL_PART}')" for p in parts) + "))"


def _ratio(top: str, bottom: str) -> str:
    return f"(cast({top} as double) / nullif(cast({bottom} as double), 0))"


def _latest(source: str, key: str, columns: list[str]) -> str:
    order = ", ".join(f"{c} desc nulls last" for c in columns)
    return (
        f"select * exclude (_rank) from (select *, row_number() over (partition by {key} order by {order}) _rank"
        f" from {source}) ranked where _rank = 1"
    )


_K1A = "md5(retailer_code || '|' || cast(store_key as varchar) || '|' || upc || '|' || cast({day} as varchar))"
_SALE = ["retailer_code", "store_key", "upc", "transaction_date", "units_sold", "revenue", "revenue_usd", "kg_sold", "promo_flag", "brand", "category"]
_STOCK = ["retailer_code", "store_key", "upc", "snapshot_date", "on_hand_qty", "in_transit_qty", "on_order_qty", "total_pipeline_qty"]

# Shared intermediate tables, by name.
STEPS: dict[str, str] = {
    "typed_order": f"""select *, {_date('order_date', '%Y%m%d')} o_day, {_date('delivery_date', '%Y%m%d')} d_day,
 {_dec('order_qty', 18, 3)} qty, {_dec('net_value', 18, 2)} val from raw_orders""",
    "good_order": "select * from typed_order where o_day is not null and qty is not null and val is not null and material_number is not null and record_id is not null",
    "bad_order": "select * from typed_order where o_day is null or qty is null or val is null or material_number is null or record_id is null",
    "staged_order": f"""select record_id, sales_org, distribution_channel, material_number, plant, customer_number,
 o_day order_date, d_day delivery_date, qty order_qty, order_qty_uom, val net_value, currency, order_type,
 _file_name _source_file, _loaded_at, timestamp '{RUN_TIME}' _staged_at from good_order""",
    "rejected_order": f"""select record_id, order_date raw_order_date, order_qty raw_order_qty, net_value raw_net_value, material_number,
 case when o_day is null then 'INVALID_DATE' when qty is null then 'INVALID_QUANTITY' when val is null then 'INVALID_NET_VALUE'
 when material_number is null then 'NULL_MATERIAL' when record_id is null then 'NULL_RECORD_ID' else 'UNKNOWN' end rejection_reason, timestamp '{RUN_TIME}' _rejected_at from bad_order""",
    "staged_pos": f"""select retailer_code, store_id, upc, {_sale_date()} transaction_date, {_dec('units_sold', 18, 0)} units_sold,
 {_dec('revenue', 18, 2)} revenue, currency_code, promo_flag = 'Y' is_promo, _file_name source_file, _loaded_at loaded_at from raw_pos
 where length({_digits('upc')}) in (12, 13) and {_dec('units_sold', 18, 0)} >= 0""",
    "staged_inventory": f"""select retailer_code, store_id, upc, {_auto_date('snapshot_date')} snapshot_date, {_dec('on_hand_qty', 18, 0)} on_hand_qty,
 {_dec('in_transit_qty', 18, 0)} in_transit_qty, {_dec('on_order_qty', 18, 0)} on_order_qty, _file_name source_file, _loaded_at loaded_at
 from raw_inventory where {_auto_date('snapshot_date')} is not null and {_dec('on_hand_qty', 18, 0)} >= 0""",
    "staged_promo": f"""select promo_id, promo_name, retailer_code, material_number, {_auto_date('start_date')} start_date, {_auto_date('end_date')} end_date,
 promo_mechanic, {_dec('discount_pct', 5, 2)} discount_pct, {_dec('trade_spend_usd', 18, 2)} trade_spend_usd, _file_name source_file,
 _loaded_at loaded_at from raw_promo""",
    "judged_pos": f"""select *, case when coalesce(length({_digits('upc')}), 0) not in (12, 13) then 'INVALID_UPC' when {_dec('units_sold', 38, 0)} is null then 'INVALID_UNITS'
 when {_dec('units_sold', 18, 0)} is null then 'UNITS_TOO_LARGE' when {_dec('units_sold', 18, 0)} < 0 then 'NEGATIVE_UNITS' end rejection_reason from raw_pos""",
    "judged_stock": f"""select *, case when {_auto_date('snapshot_date')} is null then 'INVALID_DATE' when {_dec('on_hand_qty', 38, 0)} is null then 'INVALID_QUANTITY'
 when {_dec('on_hand_qty', 18, 0)} is null then 'QUANTITY_TOO_LARGE' when {_dec('on_hand_qty', 18, 0)} < 0 then 'NEGATIVE_QUANTITY' end rejection_reason from raw_inventory""",
    "judged_text": f"""select *, case when {_dec('units_sold', 18, 0)} is null then 'UNREADABLE_UNITS' when {_dec('revenue', 18, 2)} is null then 'UNREADABLE_REVENUE'
 when {_sale_date('upper(trim(retailer_code))')} is null then 'UNREADABLE_DATE' end rejection_reason from raw_pos""",
    "live_product": "select * from dim_product where is_current",
    "wide_pos": """select s.*, st.store_key, p.unit_weight_kg, p.brand, p.category, r.rate_to_usd rate,
 s.revenue * coalesce(r.rate_to_usd, cast(1 as decimal(18,6))) usd from staged_pos s
 left join dim_store st on st.retailer_code = s.retailer_code and st.store_id = s.store_id
 left join live_product p on p.upc = s.upc
 left join dim_fx r on r.rate_date = cast(date_trunc('month', s.transaction_date) as date) and r.currency_code = s.currency_code""",
    "clean_pos": """select retailer_code, store_key, upc, transaction_date, units_sold, revenue, currency_code, cast(usd as decimal(18,2)) revenue_usd,
 is_promo promo_flag, source_file _source_file, loaded_at _loaded_at from wide_pos""",
    "wide_inventory": """select i.*, st.store_key, on_hand_qty + in_transit_qty + on_order_qty total_pipeline_qty from staged_inventory i
 left join dim_store st on st.retailer_code = i.retailer_code and st.store_id = i.store_id""",
    "clean_inventory": """select retailer_code, store_key, upc, snapshot_date, on_hand_qty, in_transit_qty, on_order_qty, source_file _source_file,
 loaded_at _loaded_at from wide_inventory""",
    "pos_fact": f"""select {_hashed('retailer_code', 'store_key', 'upc', 'transaction_date')} pos_sale_sk, retailer_code, store_key, upc, transaction_date,
 units_sold, revenue, usd revenue_usd, units_sold * coalesce(unit_weight_kg, cast(0 as decimal(10,4))) kg_sold, is_promo promo_flag, brand, category,
 loaded_at _loaded_at from wide_pos""",
    "pos_fact_merged": _latest("pos_fact", "pos_sale_sk", ["_loaded_at", *_SALE]),
    "bronze_fact": f"""select {_K1A.format(day='transaction_date')} pos_sale_sk, retailer_code, store_key, upc, transaction_date, units_sold, revenue, cast(usd as decimal(18,2)) revenue_usd,
 units_sold * coalesce(unit_weight_kg, cast(0 as decimal(10,4))) kg_sold, is_promo promo_flag, brand, category, loaded_at _loaded_at from wide_pos""",
    "bronze_keyed": "select * from bronze_fact where pos_sale_sk is not null",
    "bronze_fact_merged": _latest("bronze_keyed", "pos_sale_sk", ["_loaded_at", *_SALE]),
    "stock_fact": f"""select {_hashed('retailer_code', 'store_key', 'upc', 'snapshot_date')} inventory_sk, retailer_code, store_key, upc, snapshot_date, on_hand_qty,
 in_transit_qty, on_order_qty, total_pipeline_qty, loaded_at _loaded_at from wide_inventory""",
    "stock_fact_merged": _latest("stock_fact", "inventory_sk", ["_loaded_at", *_STOCK]),
    "promo_fact": """select m.promo_id, m.promo_name, m.retailer_code, m.material_number, p.upc, m.start_date, m.end_date, m.promo_mechanic, m.discount_pct,
 m.trade_spend_usd, date_diff('day', m.start_date, m.end_date) + 1 promo_duration_days from staged_promo m
 left join live_product p on p.material_number = m.material_number""",
    "readable_pos": f"""select *, upper(trim(retailer_code)) code, {_digits('upc')} clean_upc, {_dec('units_sold', 18, 0)} units, try_cast(revenue as double) amount,
 {_sale_date('upper(trim(retailer_code))')} sale_date from raw_pos where {_dec('units_sold', 18, 0)} is not null and {_dec('revenue', 18, 2)} is not null
 and {_sale_date('upper(trim(retailer_code))')} is not null""",
    "strict_pos": "select * from readable_pos where length(clean_upc) = 12 and units >= 0 and amount >= 0",
    "rich_pos": f"""select r.code retailer_code, trim(r.store_id) store_id, r.clean_upc upc, r.transaction_date, cast(r.units as bigint) units_sold, r.amount revenue,
 r.currency_code, r.promo_flag, r._file_name, r._loaded_at, r.sale_date, p.brand, p.category, p.unit_weight_kg, p.product_name,
 r.units * p.unit_weight_kg kg_sold, {_ratio('r.amount', 'r.units * p.unit_weight_kg')} revenue_per_kg
 from strict_pos r left join live_product p on p.upc = r.clean_upc""",
    "day_sale": """select store_key, upc, transaction_date, sum(units_sold) daily_units, sum(revenue_usd) daily_revenue, max(cast(promo_flag as int)) had_promo
 from clean_pos group by store_key, upc, transaction_date""",
    "feature": f"""select *, {_ratio('sum(daily_units) over w7', 'count(daily_units) over w7')} units_7d_avg,
 {_ratio('sum(daily_units) over w28', 'count(daily_units) over w28')} units_28d_avg,
 {_ratio('sum(daily_revenue) over w7', 'count(daily_revenue) over w7')} revenue_7d_avg,
 {_ratio('daily_units - lag(daily_units, 7) over w', 'lag(daily_units, 7) over w')} wow_growth,
 extract(dow from transaction_date) day_of_week, extract(month from transaction_date) month_num,
 case when extract(dow from transaction_date) in (6, 7) then 1 else 0 end is_weekend, sum(had_promo) over w7 promo_running_count from day_sale
 window w as (partition by store_key, upc order by transaction_date nulls last),
 w7 as (partition by store_key, upc order by transaction_date nulls last rows between 6 preceding and current row),
 w28 as (partition by store_key, upc order by transaction_date nulls last rows between 27 preceding and current row)""",
    **{f"promo_sum{m}": f"""select c.promo_id, c.promo_name, c.promo_mechanic, c.retailer_code, c.trade_spend_usd, c.discount_pct, c.start_date, c.end_date,
 date_diff('day', c.start_date, c.end_date) + 1 promo_days, p.upc, p.brand, p.category, sum(f.units_sold) promo_units,
 sum(f.units_sold * p.unit_weight_kg) promo_kg, sum(f.revenue_usd) promo_revenue
 from promo_fact c join live_product p on p.material_number = c.material_number join pos_fact{m} f on f.upc = p.upc and f.retailer_code = c.retailer_code
 and f.transaction_date between c.start_date and c.end_date group by all""" for m in ("", "_merged")},
    **{f"usual{m}": f"""select f.upc, f.retailer_code, {_ratio('sum(f.units_sold * p.unit_weight_kg)', 'count(f.units_sold * p.unit_weight_kg)')} baseline_daily_kg
 from pos_fact{m} f join live_product p on p.upc = f.upc where not exists (select 1 from promo_fact c where c.retailer_code = f.retailer_code
 and f.transaction_date between c.start_date and c.end_date) group by f.upc, f.retailer_code""" for m in ("", "_merged")},
    "brand_price": "select brand, arg_min(avg_price_per_kg, material_number) brand_price_per_kg from live_product group by brand",
    "demand": f"""select store_key, upc, {_ratio('sum(units_sold)', 'count(units_sold)')} avg_daily_units from pos_fact
 where transaction_date >= date '{AS_OF}' - interval 28 day group by store_key, upc""",
    "demand_merged": f"""select store_key, upc, {_ratio('sum(units_sold)', 'count(units_sold)')} avg_daily_units from pos_fact_merged
 where transaction_date >= date '{AS_OF}' - interval 28 day group by store_key, upc""",
    "priced_order": """select o.*, p.material_number product_number, p.upc, p.product_name, p.brand, p.category, p.sub_category, p.unit_weight_kg, r.rate_to_usd
 from staged_order o left join dim_product p on p.material_number = o.material_number and o.order_date between p.effective_from and p.effective_to
 left join dim_fx r on r.rate_date = o.order_date and r.currency_code = o.currency""",
}


def _all_text(spec: dict[str, str]) -> str:
    return ", ".join(f"cast({c} as varchar)" for c in spec)


def _weighted_digits(size: int) -> str:
    """Digits of ``d`` times 1 (last digit) and 3, 1, 3 .. going left."""
    return " + ".join(f"{1 if (size - i) % 2 == 0 else 3} * try_cast(substr(d, {i}, 1) as int)" for i in range(1, size + 1))


def _lift(fact: str = "") -> str:
    extra = "cast(s.promo_revenue as double) - b.baseline_daily_kg * s.promo_days * cast(bp.brand_price_per_kg as double)"
    daily = _ratio("s.promo_kg", "s.promo_days")
    return f"""select s.promo_id, s.promo_name, s.promo_mechanic, s.retailer_code, s.brand, s.category, s.start_date, s.end_date, s.promo_days, s.promo_kg,
 {daily} promo_daily_kg, b.baseline_daily_kg, {_ratio(daily + ' - b.baseline_daily_kg', 'b.baseline_daily_kg')} lift_pct, s.promo_revenue, s.trade_spend_usd,
 {extra} incremental_revenue_est, {_ratio(extra, 's.trade_spend_usd')} promo_roi
 from promo_sum{fact} s left join usual{fact} b on b.retailer_code = s.retailer_code and b.upc = s.upc left join brand_price bp on bp.brand = s.brand"""


# The mean over all products of the retailer of what a pairing with each of them would give.
_RETAILER_LIFT = f"""select * exclude (extra), round(extra, 6) incremental_revenue_est, round({_ratio('extra', 'trade_spend_usd')}, 6) promo_roi from (
 select s.promo_id, s.promo_name, s.promo_mechanic, s.retailer_code, s.brand, s.category, s.start_date, s.end_date, s.promo_days, sum(s.promo_kg) promo_kg,
 {_ratio('sum(s.promo_kg)', 's.promo_days')} promo_daily_kg, coalesce(b.products, 0) products, round(b.base, 6) baseline_daily_kg,
 round({_ratio('sum(s.promo_kg)', 's.promo_days')} * b.inverse - 1, 6) lift_pct, sum(s.promo_revenue) promo_revenue, s.trade_spend_usd,
 cast(sum(s.promo_revenue) as double) - b.base * s.promo_days * cast(bp.brand_price_per_kg as double) extra
 from promo_sum s left join (select retailer_code, count(baseline_daily_kg) products, avg(baseline_daily_kg) base, avg(1 / nullif(baseline_daily_kg, 0)) inverse
 from usual group by retailer_code) b on b.retailer_code = s.retailer_code left join brand_price bp on bp.brand = s.brand
 group by s.promo_id, s.promo_name, s.promo_mechanic, s.retailer_code, s.brand, s.category, s.start_date, s.end_date, s.promo_days, s.trade_spend_usd,
 b.products, b.base, b.inverse, bp.brand_price_per_kg) lifted"""


def _weekly(fact: str) -> str:
    return f"""select cast(date_trunc('week', f.transaction_date) as date) week_start, st.retailer_name, st.region, st.store_name, st.store_id, p.brand, p.category,
 p.sub_category, sum(f.units_sold) total_units, sum(f.units_sold * p.unit_weight_kg) total_kg, sum(f.revenue_usd) total_revenue_usd,
 count(distinct f.transaction_date) selling_days, {_ratio('sum(f.units_sold * p.unit_weight_kg)', 'count(distinct f.transaction_date)')} avg_daily_kg
 from {fact} f join dim_store st on st.store_key = f.store_key join live_product p on p.upc = f.upc group by all"""


def _check(name: str, severity: str, violations: str) -> str:
    return f"select '{name}' check_name, '{severity}' severity, ({violations}) violations"


def _report(lines: list[tuple[str, str, str]]) -> str:
    return "select *, violations = 0 passed, case when violations = 0 then 'PASS' when severity = 'warn' then 'WARN' else 'ERROR' end status from (" + " union all ".join(_check(*line) for line in lines) + ") lines"


def _repeats(table: str, column: str, null_too: bool = False) -> str:
    only = "" if null_too else f" where {column} is not null"
    return f"select count(*) from (select {column} from {table}{only} group by {column} having count(*) > 1) r"


def _strays(table: str, column: str, parent: str, null_too: bool = False) -> str:
    also = f" or c.{column} is null" if null_too else ""
    return (
        f"select count(*) from {table} c where (c.{column} is not null and not exists"
        f" (select 1 from {parent} p where p.{column} = c.{column})){also}"
    )


_MODEL_LINES = [
    ("fct_pos_sales.pos_sale_sk.unique", "error", _repeats("pos_fact", "pos_sale_sk")),
    ("fct_pos_sales.pos_sale_sk.not_null", "error", "select count(*) from pos_fact where pos_sale_sk is null"),
    ("fct_pos_sales.transaction_date.not_null", "error", "select count(*) from pos_fact where transaction_date is null"),
    ("fct_pos_sales.units_sold.not_null", "error", "select count(*) from pos_fact where units_sold is null"),
    ("fct_pos_sales.units_sold.minimum", "error", "select count(*) from pos_fact where units_sold < 0"),
    ("fct_pos_sales.store_key.reference", "warn", _strays("pos_fact", "store_key", "dim_store")),
    ("fct_inventory.inventory_sk.unique", "error", _repeats("stock_fact", "inventory_sk")),
    ("fct_inventory.inventory_sk.not_null", "error", "select count(*) from stock_fact where inventory_sk is null"),
    ("fct_inventory.on_hand_qty.not_null", "error", "select count(*) from stock_fact where on_hand_qty is null"),
    ("fct_inventory.on_hand_qty.minimum", "error", "select count(*) from stock_fact where on_hand_qty < 0"),
    ("fct_promotions.promo_id.unique", "error", _repeats("promo_fact", "promo_id")),
    ("fct_promotions.promo_id.not_null", "error", "select count(*) from promo_fact where promo_id is null"),
    ("fct_promotions.start_date.not_null", "error", "select count(*) from promo_fact where start_date is null"),
    ("fct_promotions.material_number.not_null", "error", "select count(*) from promo_fact where material_number is null"),
    ("fct_promotions.material_number.reference", "warn", _strays("promo_fact", "material_number", "dim_product")),
]
_MERGED_LINES = [
    (name, severity, sql.replace("pos_fact", "pos_fact_merged").replace("stock_fact", "stock_fact_merged"))
    for name, severity, sql in _MODEL_LINES
]
_ASSERTION_LINES = [
    ("fct_pos_sales.pos_sale_sk.unique_or_null", "error", _repeats("pos_fact", "pos_sale_sk", True)),
    ("fct_pos_sales.store_key.reference", "error", _strays("pos_fact", "store_key", "dim_store")),
    ("fct_pos_sales.units_sold.minimum", "error", "select count(*) from pos_fact where units_sold < 0"),
    ("fct_inventory.on_hand_qty.minimum", "error", "select count(*) from stock_fact where on_hand_qty < 0"),
    ("fct_promotions.start_date.ordered", "error", "select count(*) from promo_fact where start_date > end_date"),
    ("fct_promotions.material_number.reference_or_null", "error", _strays("promo_fact", "material_number", "dim_product", True)),
]

_ORDER_SPEC = _columns(schemas.ORDERS_STAGED)
_REJECT_SPEC = _columns(schemas.ORDERS_REJECTED)
_CLEAN_POS_SPEC = _columns(schemas.POS_CLEANSED)
_CLEAN_INV_SPEC = _columns(schemas.INVENTORY_CLEANSED)
_POS_FACT_SPEC = _columns(schemas.FCT_POS_SALES)
_STOCK_FACT_SPEC = _columns(schemas.FCT_INVENTORY)
_PROMO_FACT_SPEC = dict(promo_id=TEXT, promo_name=TEXT, retailer_code=TEXT, material_number=TEXT, upc=TEXT, start_date=TEXT, end_date=TEXT, promo_mechanic=TEXT, discount_pct=NUMBER, trade_spend_usd=NUMBER, promo_duration_days=WHOLE)
_LIFT_SPEC = dict(promo_id=TEXT, promo_name=TEXT, promo_mechanic=TEXT, retailer_code=TEXT, brand=TEXT, category=TEXT, start_date=TEXT, end_date=TEXT, promo_days=WHOLE, promo_kg=NUMBER, promo_daily_kg=NUMBER, baseline_daily_kg=NUMBER, lift_pct=NUMBER, promo_revenue=NUMBER, trade_spend_usd=NUMBER, incremental_revenue_est=NUMBER, promo_roi=NUMBER)
_WEEKLY_SPEC = dict(week_start=TEXT, retailer_name=TEXT, region=TEXT, store_name=TEXT, store_id=TEXT, brand=TEXT, category=TEXT, sub_category=TEXT, total_units=NUMBER, total_kg=NUMBER, total_revenue_usd=NUMBER, selling_days=WHOLE, avg_daily_kg=NUMBER)
_PRODUCT_SPEC = _columns(schemas.DIM_PRODUCT)
_RAW_STOCK_SPEC = _columns(schemas.RAW_INVENTORY)
_RAW_POS_SPEC = _columns(schemas.RAW_POS)
_FEATURE_SPEC = dict(store_key=WHOLE, upc=TEXT, transaction_date=TEXT, daily_units=NUMBER, daily_revenue=NUMBER, had_promo=WHOLE, units_7d_avg=NUMBER, units_28d_avg=NUMBER, revenue_7d_avg=NUMBER, promo_running_count=WHOLE, wow_growth=NUMBER, day_of_week=WHOLE, month_num=WHOLE, is_weekend=WHOLE)
_REPORT_SPEC = dict(check_name=TEXT, severity=TEXT, violations=WHOLE, passed=WHOLE, status=TEXT)
_RICH_SPEC = dict(upc=TEXT, retailer_code=TEXT, store_id=TEXT, transaction_date=TEXT, units_sold=WHOLE, revenue=NUMBER, currency_code=TEXT, promo_flag=TEXT, _file_name=TEXT, _loaded_at=TEXT, sale_date=TEXT, brand=TEXT, category=TEXT, unit_weight_kg=NUMBER, product_name=TEXT, kg_sold=NUMBER, revenue_per_kg=NUMBER)
_AUDIT_SPEC = _columns(schemas.POS_QUALITY_LOG)



def _availability(merged: str = "") -> str:
    return f"""select *, case when on_hand_qty = 0 then 'OUT_OF_STOCK' when days_of_supply < 3 then 'CRITICAL' when days_of_supply < 7 then 'LOW' when days_of_supply > 28 then 'OVERSTOCK' else 'HEALTHY' end availability_status
 from (select i.snapshot_date, st.retailer_name, st.region, st.store_name, st.store_id, p.brand, p.category, p.product_name, i.on_hand_qty, i.in_transit_qty, d.avg_daily_units,
 {_ratio('i.on_hand_qty', 'd.avg_daily_units')} days_of_supply, {_ratio('i.on_hand_qty + i.in_transit_qty', 'd.avg_daily_units')} days_of_supply_incl_transit
 from stock_fact{merged} i join dim_store st on st.store_key = i.store_key join live_product p on p.upc = i.upc left join demand{merged} d on d.store_key = i.store_key and d.upc = i.upc) x"""


_SHELF_SPEC = dict(snapshot_date=TEXT, retailer_name=TEXT, region=TEXT, store_name=TEXT, store_id=TEXT, brand=TEXT, category=TEXT, product_name=TEXT, on_hand_qty=NUMBER, in_transit_qty=NUMBER, avg_daily_units=NUMBER, days_of_supply=NUMBER, days_of_supply_incl_transit=NUMBER, availability_status=TEXT)


def _audit(moment: str, hours: int) -> str:
    return f"""select timestamp '{moment}' audit_timestamp, count(*) total_rows, count(*) filter (where store_key is null) null_store_key_count,
 count(*) filter (where transaction_date > cast(timestamp '{moment}' as date)) future_date_count, count(*) filter (where revenue < 0) negative_revenue_count
 from clean_pos where _loaded_at >= timestamp '{moment}' - interval {hours} hour"""


_NUMBERED_PRODUCTS = f"""select row_number() over (order by material_number, effective_from) product_sk, *,
 timestamp '{RUN_TIME}' _updated_at from dim_product"""


# Query name -> (SQL over the steps and feeds, column types).
_ORACLES: dict[str, tuple[str, dict[str, str]]] = {
    "raw_orders": (f"select * replace ('csv' as _file_name, timestamp '{RUN_TIME}' as _loaded_at) from raw_orders",
        dict(record_id=TEXT, sales_org=TEXT, distribution_channel=TEXT, material_number=TEXT, plant=TEXT, customer_number=TEXT, order_date=TEXT, delivery_date=TEXT, order_qty=TEXT, order_qty_uom=TEXT, net_value=TEXT, currency=TEXT, order_type=TEXT, _file_name=TEXT, _loaded_at=TEXT)),
    "raw_pos": ("select * from raw_pos", _RAW_POS_SPEC),
    "raw_inventory": ("select * from raw_inventory", _RAW_STOCK_SPEC),
    "raw_promo": ("select * from raw_promo", dict(promo_id=TEXT, promo_name=TEXT, retailer_code=TEXT, material_number=TEXT, start_date=TEXT, end_date=TEXT, promo_mechanic=TEXT, discount_pct=TEXT, trade_spend_usd=TEXT, _file_name=TEXT, _loaded_at=TEXT)),
    "dim_product": ("select * from dim_product", _PRODUCT_SPEC),
    "dim_store": ("select * from dim_store", dict(store_key=WHOLE, retailer_code=TEXT, retailer_name=TEXT, store_id=TEXT, store_name=TEXT, city=TEXT, state=TEXT, region=TEXT, country=TEXT)),
    "dim_fx": ("select * from dim_fx", dict(rate_date=TEXT, currency_code=TEXT, rate_to_usd=NUMBER)),
    "file_lineage": (f"select 'lineitem' source_table, timestamp '{RUN_TIME}' _loaded_at, count(*) as rows from lineitem", dict(source_table=TEXT, _loaded_at=TEXT, rows=WHOLE)),
    "append_orders": ("select * from staged_order", _ORDER_SPEC),
    "overwrite_enriched_pos": ("select brand, count(*) as rows, sum(units_sold) units, sum(kg_sold) kg, (select count(*) from rich_pos) rows_written from rich_pos group by brand",
        dict(brand=TEXT, rows=WHOLE, units=WHOLE, kg=NUMBER, rows_written=WHOLE)),
    "rebuild_promotions": ("select * from promo_fact", _PROMO_FACT_SPEC),
    "clustered_pos_sales": ("select cast(date_trunc('month', transaction_date) as date) sale_month, retailer_code, count(*) as rows, sum(units_sold) units, sum(kg_sold) kg from pos_fact group by all",
        dict(sale_month=TEXT, retailer_code=TEXT, rows=WHOLE, units=NUMBER, kg=NUMBER)),
    "sorted_products": (_NUMBERED_PRODUCTS, dict(product_sk=WHOLE) | _PRODUCT_SPEC | dict(_updated_at=TEXT)),
    "built_features": ("select store_key, count(*) as rows, sum(daily_units) units, (select count(*) from day_sale) rows_written from day_sale group by store_key", dict(store_key=WHOLE, rows=WHOLE, units=NUMBER, rows_written=WHOLE)),
    "named_tables": ("select st.region, f.brand, sum(f.units_sold) units from pos_fact f join dim_store st on st.store_key = f.store_key group by all", dict(region=TEXT, brand=TEXT, units=NUMBER)),
    "staging_views": ("select 'stg_pos' view_name, count(*) as rows, max(loaded_at) newest from staged_pos union all select 'stg_inventory', count(*), max(loaded_at) from staged_inventory union all select 'stg_promo', count(*), max(loaded_at) from staged_promo",
        dict(view_name=TEXT, rows=WHOLE, newest=TEXT)),
    "order_dates": ("select o_day order_date, count(*) as rows from typed_order group by all", dict(order_date=TEXT, rows=WHOLE)),
    "snapshot_dates": (f"select {_auto_date('snapshot_date')} snapshot_date, count(*) as rows from raw_inventory group by 1", dict(snapshot_date=TEXT, rows=WHOLE)),
    "sale_dates": (f"select retailer_code, {_sale_date()} sale_date, count(*) as rows from raw_pos group by 1, 2", dict(retailer_code=TEXT, sale_date=TEXT, rows=WHOLE)),
    "parsed_numbers": (f"""select store_id, sum({_dec('units_sold', 18, 0)}) units, sum({_dec('revenue', 18, 2)}) revenue,
 count(*) - count({_dec('units_sold', 18, 0)}) bad_units, count(*) - count({_dec('revenue', 18, 2)}) bad_revenue from raw_pos group by store_id""",
        dict(store_id=TEXT, units=NUMBER, revenue=NUMBER, bad_units=WHOLE, bad_revenue=WHOLE)),
    "strict_sales": ("select code retailer_code, sale_date, count(*) as rows, sum(units) units from strict_pos group by all", dict(retailer_code=TEXT, sale_date=TEXT, rows=WHOLE, units=WHOLE)),
    "promo_flags": ("select store_id, promo_flag = 'Y' is_promo, count(*) as rows, max(case promo_flag when 'Y' then 1 when 'N' then 0 end) had_promo from raw_pos group by 1, 2", dict(store_id=TEXT, is_promo=WHOLE, rows=WHOLE, had_promo=WHOLE)),
    "tidy_codes": (f"select upper(trim(retailer_code)) retailer_code, length({_digits('upc')}) upc_digits, count(*) as rows, min({_digits('upc')}) first_upc from raw_pos group by 1, 2", dict(retailer_code=TEXT, upc_digits=WHOLE, rows=WHOLE, first_upc=TEXT)),
    "unit_prices": (f"select *, {_ratio('amount', 'pieces')} unit_price, {_ratio('amount', 'pieces')} < 1000 is_cheap from (select store_id, upc, sum(revenue) amount, sum(units_sold) pieces from staged_pos group by all) g",
        dict(store_id=TEXT, upc=TEXT, amount=NUMBER, pieces=NUMBER, unit_price=NUMBER, is_cheap=WHOLE)),
    "check_digits": (f"""select store_id, count(*) as rows, count(*) filter (where length(d) = 12 and ({_weighted_digits(12)}) % 10 = 0) passing
 from (select store_id, {_digits('upc')} d from raw_pos) c group by store_id""", dict(store_id=TEXT, passing=WHOLE, rows=WHOLE)),
    "order_counts": ("select staged, rejected, 'Staged: ' || staged || ' rows. Rejected: ' || rejected || ' rows.' message from (select (select count(*) from good_order) staged, (select count(*) from bad_order) rejected) c", dict(staged=WHOLE, rejected=WHOLE, message=TEXT)),
    "upc_and_units": ("select upc, count(*) as rows from staged_pos group by upc", dict(upc=TEXT, rows=WHOLE)),
    "stock_counts": ("select snapshot_date, count(*) as rows, sum(on_hand_qty) on_hand from staged_inventory group by snapshot_date", dict(snapshot_date=TEXT, rows=WHOLE, on_hand=NUMBER)),
    "current_products": ("select * from live_product", _PRODUCT_SPEC),
    "recent_demand": ("select * from demand", dict(store_key=WHOLE, upc=TEXT, avg_daily_units=NUMBER)),
    "store_lookup": ("select retailer_code, store_id, store_key, count(*) as rows from wide_pos group by all", dict(retailer_code=TEXT, store_id=TEXT, store_key=WHOLE, rows=WHOLE)),
    "product_lookup": ("select upc, brand, category, count(*) as rows from wide_pos group by all", dict(upc=TEXT, brand=TEXT, category=TEXT, rows=WHOLE)),
    "promo_products": ("select promo_id, material_number, upc from promo_fact", dict(promo_id=TEXT, material_number=TEXT, upc=TEXT)),
    "monthly_rates": ("select currency_code, count(*) as rows, count(*) - count(rate) without_rate from wide_pos group by currency_code", dict(currency_code=TEXT, rows=WHOLE, without_rate=WHOLE)),
    "daily_rates": ("select currency, count(*) as rows, count(*) - count(rate_to_usd) without_rate from priced_order group by currency", dict(currency=TEXT, rows=WHOLE, without_rate=WHOLE)),
    "product_as_of": ("select material_number, unit_weight_kg product_unit_weight_kg, count(*) as rows, min(order_date) as first, max(order_date) as last from priced_order group by 1, 2", dict(material_number=TEXT, product_unit_weight_kg=NUMBER, rows=WHOLE, first=TEXT, last=TEXT)),
    "sales_by_place": ("select st.region, p.sub_category, count(*) as rows, sum(f.units_sold) units from pos_fact f join dim_store st on st.store_key = f.store_key join live_product p on p.upc = f.upc group by all", dict(region=TEXT, sub_category=TEXT, rows=WHOLE, units=NUMBER)),
    "promo_sales": ("select * from promo_sum", dict(promo_id=TEXT, promo_name=TEXT, promo_mechanic=TEXT, retailer_code=TEXT, trade_spend_usd=NUMBER, discount_pct=NUMBER, start_date=TEXT, end_date=TEXT, promo_days=WHOLE, brand=TEXT, category=TEXT, promo_units=NUMBER, promo_kg=NUMBER, promo_revenue=NUMBER)),
    "baseline_sales": ("select * from usual", dict(upc=TEXT, retailer_code=TEXT, baseline_daily_kg=NUMBER)),
    "promo_calendar_days": ("select distinct retailer_code, cast(unnest(generate_series(start_date, end_date, interval 1 day)) as date) transaction_date from promo_fact where start_date <= end_date", dict(retailer_code=TEXT, transaction_date=TEXT)),
    "stock_and_demand": ("select i.store_key, i.upc, i.snapshot_date, i.on_hand_qty, d.avg_daily_units from stock_fact i left join demand d on d.store_key = i.store_key and d.upc = i.upc where i.store_key is not null and i.upc is not null", dict(store_key=WHOLE, upc=TEXT, snapshot_date=TEXT, on_hand_qty=NUMBER, avg_daily_units=NUMBER)),
    "orphan_upcs": ("select upc, count(*) as rows from staged_pos s where upc is not null and not exists (select 1 from dim_product p where p.upc = s.upc) group by upc", dict(upc=TEXT, rows=WHOLE)),
    "brand_prices": ("select * from brand_price", dict(brand=TEXT, brand_price_per_kg=NUMBER)),
    "rows_after_mark": (f"select loaded_at, count(*) as rows from staged_pos where loaded_at > (select max(loaded_at) from staged_pos where loaded_at <= timestamp '{FIRST_LOAD_END}') group by loaded_at", dict(loaded_at=TEXT, rows=WHOLE)),
    "daily_store_sales": ("select * from day_sale", dict(store_key=WHOLE, upc=TEXT, transaction_date=TEXT, daily_units=NUMBER, daily_revenue=NUMBER, had_promo=WHOLE)),
    "selling_days": ("select store_key, brand, count(distinct transaction_date) selling_days, sum(units_sold) units from pos_fact group by all", dict(store_key=WHOLE, brand=TEXT, selling_days=WHOLE, units=NUMBER)),
    "repeated_keys": ("select pos_sale_sk, count(*) as rows from pos_fact group by pos_sale_sk having count(*) > 1", dict(pos_sale_sk=TEXT, rows=WHOLE)),
    "demand_features": ("select * from feature", _FEATURE_SPEC),
    "demand_features_iso_week": ("select store_key, upc, transaction_date, extract(isodow from transaction_date) day_of_week, extract(month from transaction_date) month_num, case when extract(isodow from transaction_date) >= 6 then 1 else 0 end is_weekend from day_sale",
        dict(store_key=WHOLE, upc=TEXT, transaction_date=TEXT, day_of_week=WHOLE, month_num=WHOLE, is_weekend=WHOLE)),
    "days_since_stockout": ("""select * exclude (last_out), date_diff('day', last_out, transaction_date) days_since_stockout from feature join (
 select f.store_key s_key, f.upc s_upc, f.transaction_date s_day, max(o.snapshot_date) last_out from day_sale f left join clean_inventory o
 on o.store_key = f.store_key and o.upc = f.upc and o.on_hand_qty = 0 and o.snapshot_date <= f.transaction_date group by all) g
 on s_key is not distinct from store_key and s_upc = upc and s_day is not distinct from transaction_date""", _FEATURE_SPEC | dict(days_since_stockout=WHOLE)),
    "latest_sales": ("""select retailer_code, store_id, upc, sale_date, product_name, brand, units_sold, kg_sold, revenue, revenue_per_kg, promo_flag from rich_pos
 order by sale_date desc nulls first, retailer_code nulls last, store_id nulls last, upc nulls last, product_name nulls last, brand nulls last, units_sold nulls last, kg_sold nulls last, revenue nulls last, revenue_per_kg nulls last, promo_flag nulls last limit 20""",
        dict(retailer_code=TEXT, store_id=TEXT, upc=TEXT, sale_date=TEXT, product_name=TEXT, brand=TEXT, units_sold=WHOLE, kg_sold=NUMBER, revenue=NUMBER, revenue_per_kg=NUMBER, promo_flag=TEXT)),
    "calendar_functions": ("""select distinct order_date, cast(date_trunc('week', order_date) as date) week_start, cast(date_trunc('month', order_date) as date) month_start,
 cast(order_date - interval 28 day as date) four_weeks_before, day(order_date) day_of_month, extract(dow from order_date) day_of_week, month(order_date) month_num,
 cast(order_date as timestamp) - interval 1 hour hour_before from staged_order""",
        dict(order_date=TEXT, week_start=TEXT, month_start=TEXT, four_weeks_before=TEXT, day_of_month=WHOLE, day_of_week=WHOLE, month_num=WHOLE, hour_before=TEXT)),
    "stage_orders": ("select * from staged_order", _ORDER_SPEC),
    "quarantine_orders": ("select * from rejected_order", _REJECT_SPEC),
    "cleanse_pos": ("select * from clean_pos", _CLEAN_POS_SPEC),
    "cleanse_inventory": ("select * from clean_inventory", _CLEAN_INV_SPEC),
    "pos_quality_audit": (_audit(AUDIT_AT, 1), _AUDIT_SPEC),
    "pos_quality_audit_all": (_audit("2000-01-01 00:00:00", 24 * 365 * 10), _AUDIT_SPEC),
    "enrich_pos": ("select * from rich_pos", _RICH_SPEC),
    "stg_pos": ("select * from staged_pos", dict(retailer_code=TEXT, store_id=TEXT, upc=TEXT, transaction_date=TEXT, units_sold=NUMBER, revenue=NUMBER, currency_code=TEXT, is_promo=WHOLE, source_file=TEXT, loaded_at=TEXT)),
    "stg_inventory": ("select * from staged_inventory", dict(retailer_code=TEXT, store_id=TEXT, upc=TEXT, snapshot_date=TEXT, on_hand_qty=NUMBER, in_transit_qty=NUMBER, on_order_qty=NUMBER, source_file=TEXT, loaded_at=TEXT)),
    "stg_promo": ("select * from staged_promo", dict(promo_id=TEXT, promo_name=TEXT, retailer_code=TEXT, material_number=TEXT, start_date=TEXT, end_date=TEXT, promo_mechanic=TEXT, discount_pct=NUMBER, trade_spend_usd=NUMBER, source_file=TEXT, loaded_at=TEXT)),
    "fct_pos_sales": ("select * from pos_fact", _POS_FACT_SPEC),
    "fct_pos_sales_by_store_id": (f"select {_hashed('retailer_code', 'store_id', 'upc', 'transaction_date')} pos_sale_sk, store_key, upc, transaction_date, units_sold from wide_pos", dict(pos_sale_sk=TEXT, store_key=WHOLE, upc=TEXT, transaction_date=TEXT, units_sold=NUMBER)),
    "fct_pos_sales_from_bronze": ("select * from bronze_fact", _POS_FACT_SPEC),
    "fct_inventory": ("select * from stock_fact", _STOCK_FACT_SPEC),
    "fct_inventory_from_bronze": (f"select {_K1A.format(day='snapshot_date')} inventory_sk, retailer_code, store_key, upc, snapshot_date, on_hand_qty, in_transit_qty, on_order_qty, total_pipeline_qty, loaded_at _loaded_at from wide_inventory", _STOCK_FACT_SPEC),
    "fct_promotions": ("select * from promo_fact", _PROMO_FACT_SPEC),
    "fct_promotions_loaded": (f"select *, timestamp '{RUN_TIME}' _loaded_at from promo_fact", _PROMO_FACT_SPEC | dict(_loaded_at=TEXT)),
    "dim_product_versions": (_NUMBERED_PRODUCTS, dict(product_sk=WHOLE) | _PRODUCT_SPEC | dict(_updated_at=TEXT)),
    "lasting_product_numbers": (f"""select row_number() over (order by category = 'SMALL', material_number, effective_from) product_sk, *,
 timestamp '{RUN_TIME}' _updated_at from dim_product""", dict(product_sk=WHOLE) | _PRODUCT_SPEC | dict(_updated_at=TEXT)),
    "numbered_orders": ("select 1000 + row_number() over (order by record_id, plant, order_qty) order_sk, record_id, plant, order_qty from (select record_id, plant, coalesce(order_qty, '') order_qty from raw_orders) r", dict(order_sk=WHOLE, record_id=TEXT, plant=TEXT, order_qty=TEXT)),
    "hashed_products": ("select material_number, count(*) versions from dim_product group by material_number", dict(material_number=TEXT, versions=WHOLE)),
    "conformed_sales": ("""select record_id sales_order_id, sales_org, distribution_channel, order_type, order_date, delivery_date, plant, product_number material_number, upc, product_name, brand, category,
 sub_category, order_qty, order_qty_uom, order_qty * unit_weight_kg order_weight_kg, net_value, currency, net_value * coalesce(rate_to_usd, cast(1 as decimal(18,6))) net_value_usd, customer_number,
 _staged_at source_timestamp from priced_order""",
        dict(sales_order_id=TEXT, sales_org=TEXT, distribution_channel=TEXT, order_type=TEXT, order_date=TEXT, delivery_date=TEXT, plant=TEXT, material_number=TEXT, upc=TEXT, product_name=TEXT, brand=TEXT, category=TEXT, sub_category=TEXT, order_qty=NUMBER, order_qty_uom=TEXT, order_weight_kg=NUMBER, net_value=NUMBER, currency=TEXT, net_value_usd=NUMBER, customer_number=TEXT, source_timestamp=TEXT)),
    "weekly_store_demand": (_weekly("pos_fact"), _WEEKLY_SPEC),
    "promo_lift": (_lift(), _LIFT_SPEC),
    "promo_lift_by_retailer": (_RETAILER_LIFT, dict(promo_id=TEXT, promo_name=TEXT, promo_mechanic=TEXT, retailer_code=TEXT, brand=TEXT, category=TEXT, start_date=TEXT, end_date=TEXT, promo_days=WHOLE, promo_kg=NUMBER, promo_daily_kg=NUMBER, products=WHOLE, baseline_daily_kg=NUMBER, lift_pct=NUMBER, promo_revenue=NUMBER, trade_spend_usd=NUMBER, incremental_revenue_est=NUMBER, promo_roi=NUMBER)),
    "on_shelf_availability": (_availability(), _SHELF_SPEC),
    "incremental_pos_sales": ("select * from pos_fact_merged", _POS_FACT_SPEC),
    "late_sales": ("select * from pos_fact_merged", _POS_FACT_SPEC),
    "sales_with_layouts": ("select pos_sale_sk, transaction_date, units_sold from pos_fact_merged union all select inventory_sk, snapshot_date, on_hand_qty from stock_fact_merged",
        dict(pos_sale_sk=TEXT, transaction_date=TEXT, units_sold=NUMBER)),
    "found_layouts": ("""select retailer_code, case when best = 0 then null when iso = best and not dotted then 'yyyy-MM-dd' when iso = best then 'dd.MM.yyyy' when us = best then 'MM/dd/yyyy'
 else 'yyyyMMdd' end layout, texts, best fits, best > 0 and us = best and day_first = best ambiguous from (select *, greatest(iso, us, compact) best from (
 select retailer_code, starts_with(retailer_code, 'R') dotted, count(transaction_date) texts, count(try_strptime(transaction_date, '%Y-%m-%d')) iso, count(try_strptime(transaction_date, '%m/%d/%Y')) us,
 count(try_strptime(transaction_date, '%Y%m%d')) compact, count(try_strptime(transaction_date, '%d/%m/%Y')) day_first from raw_pos group by retailer_code) g) b""",
        dict(retailer_code=TEXT, layout=TEXT, texts=WHOLE, fits=WHOLE, ambiguous=WHOLE)),
    "sales_of_found_layouts": (f"""select retailer_code, cast(coalesce(try_strptime(transaction_date, '%Y-%m-%d'), try_strptime(transaction_date, '%m/%d/%Y'), try_strptime(transaction_date, '%Y%m%d')) as date) transaction_date,
 count(*) as rows, sum({_dec('units_sold', 18, 0)}) units from raw_pos where length({_digits('upc')}) in (12, 13) and {_dec('units_sold', 18, 0)} >= 0 group by 1, 2""", dict(retailer_code=TEXT, transaction_date=TEXT, rows=WHOLE, units=NUMBER)),
    "stores_lacking_required": ("""select store_key, store_name, case when store_key % 5 = 0 and store_key % 7 = 0 then 'retailer_code,store_id' when store_key % 5 = 0 then 'retailer_code' else 'store_id' end missing
 from dim_store where store_key % 5 = 0 or store_key % 7 = 0""", dict(store_key=WHOLE, store_name=TEXT, missing=TEXT)),
    "full_refresh_pos_sales": ("select * from pos_fact_merged", _POS_FACT_SPEC),
    "incremental_from_bronze": ("select * from bronze_fact_merged", _POS_FACT_SPEC),
    "build_report": (_report(_MERGED_LINES), _REPORT_SPEC),
    "build_counts": (f"""select 'conformed_sales' table_name, count(*) rows_written, count(*) as rows, cast(sum(net_value * coalesce(rate_to_usd, cast(1 as decimal(18,6)))) as decimal(38,4)) total from priced_order
 union all select 'weekly_store_demand', count(*), count(*), cast(sum(total_kg) as decimal(38,4)) from ({_weekly('pos_fact_merged')}) w
 union all select 'promo_lift', count(*), count(*), cast(sum(promo_kg) as decimal(38,4)) from ({_lift('_merged')}) l
 union all select 'on_shelf_availability', count(*), count(*), cast(sum(i.on_hand_qty) as decimal(38,4)) from stock_fact_merged i join dim_store st on st.store_key = i.store_key join live_product p on p.upc = i.upc""",
        dict(table_name=TEXT, rows_written=WHOLE, rows=WHOLE, total=NUMBER)),
    "incremental_inventory": ("select * from stock_fact_merged", _STOCK_FACT_SPEC),
    "order_changes": ("""select case when copies > 0 then 'INSERT' else 'DELETE' end change, max(copies > 0) over (partition by record_id) and max(copies < 0) over (partition by record_id) is_update, abs(copies) copies,
 record_id, material_number, order_qty, net_value, plant, order_type from (select record_id, material_number, order_qty, net_value, plant, order_type, sum(n) copies from (
 select record_id, material_number, order_qty, net_value, plant, order_type, -1 n from raw_orders union all
 select record_id, material_number, order_qty, case when order_type = 'A' then '1' || net_value else net_value end, plant, order_type, 1 from raw_orders where not (order_type = 'N' and plant = 'PL00') union all
 select record_id || '-B', material_number, order_qty, net_value, plant, order_type, 1 from raw_orders where plant = 'PL01') u group by all having sum(n) <> 0) g""",
        dict(change=TEXT, is_update=WHOLE, copies=WHOLE, record_id=TEXT, material_number=TEXT, order_qty=TEXT, net_value=TEXT, plant=TEXT, order_type=TEXT)),
    "promo_changes": ("""select 'DELETE' change, true is_update, 1 copies, promo_id, retailer_code, start_date, end_date, discount_pct from staged_promo where discount_pct > 25 and end_date is not null
 union all select 'INSERT', true, 1, promo_id, retailer_code, start_date, cast(end_date + interval 7 day as date), discount_pct from staged_promo where discount_pct > 25 and end_date is not null""",
        dict(change=TEXT, is_update=WHOLE, copies=WHOLE, promo_id=TEXT, retailer_code=TEXT, start_date=TEXT, end_date=TEXT, discount_pct=NUMBER)),
    "new_product_versions": ("""select * from dim_product where not (is_current and category = 'PROMO') union all
 select * replace (date '1999-12-31' as effective_to, false as is_current) from live_product where category = 'PROMO' union all
 select * replace (avg_price_per_kg + 1 as avg_price_per_kg, date '2000-01-01' as effective_from) from live_product where category = 'PROMO' union all
 select material_number || '-N', '9' || substr(upc, 2, 11), null, brand, category, null, null, null, avg_price_per_kg, date '2000-01-01', date '9999-12-31', true from live_product where category = 'SMALL'""", _PRODUCT_SPEC),
    "rejected_sales": (f"select *, timestamp '{RUN_TIME}' _rejected_at from judged_pos where rejection_reason is not null", _RAW_POS_SPEC | dict(rejection_reason=TEXT, _rejected_at=TEXT)),
    "rejected_stock": (f"select *, timestamp '{RUN_TIME}' _rejected_at from judged_stock where rejection_reason is not null", _RAW_STOCK_SPEC | dict(rejection_reason=TEXT, _rejected_at=TEXT)),
    "unreadable_sales": (f"select *, timestamp '{RUN_TIME}' _rejected_at from judged_text where rejection_reason is not null", _RAW_POS_SPEC | dict(rejection_reason=TEXT, _rejected_at=TEXT)),
    "feed_counts": ("""select 'orders' feed, (select count(*) from raw_orders) landed, (select count(*) from good_order) accepted, (select count(*) from bad_order) rejected
 union all select 'sales', (select count(*) from raw_pos), (select count(*) from staged_pos), (select count(*) from judged_pos where rejection_reason is not null)
 union all select 'stock', (select count(*) from raw_inventory), (select count(*) from staged_inventory), (select count(*) from judged_stock where rejection_reason is not null)
 union all select 'readable sales', (select count(*) from raw_pos), (select count(*) from readable_pos), (select count(*) from judged_text where rejection_reason is not null)""",
        dict(feed=TEXT, landed=WHOLE, accepted=WHOLE, rejected=WHOLE)),
    "keyless_sales": ("select * from bronze_fact where pos_sale_sk is null", _POS_FACT_SPEC),
    "sales_from_bronze_build": ("select * from bronze_fact_merged", _POS_FACT_SPEC),
    "stream_pos": ("select * from clean_pos", _CLEAN_POS_SPEC),
    "stream_orders": ("select * from staged_order", _ORDER_SPEC),
    "stream_rejects": ("select * from rejected_order", _REJECT_SPEC),
    "stream_reruns": ("select 0 batches_of_second_run, (select count(*) from good_order) staged, (select count(*) from bad_order) rejected", dict(batches_of_second_run=WHOLE, staged=WHOLE, rejected=WHOLE)),
    "stream_pos_audits": (_audit(AUDIT_AT, 1), _AUDIT_SPEC),
    "stream_inventory": ("select * from clean_inventory", _CLEAN_INV_SPEC),
    "refreshed_weekly_demand": (_weekly("pos_fact_merged"), _WEEKLY_SPEC),
    "refreshed_weekly_demand_of_new_master": (_weekly("pos_fact_merged"), _WEEKLY_SPEC),
    "kept_selling_days": ("select store_key, brand, count(distinct transaction_date) selling_days from pos_fact_merged group by store_key, brand", dict(store_key=WHOLE, brand=TEXT, selling_days=WHOLE)),
    "demand_features_by_calendar": (f"""select d.store_key, d.upc, d.transaction_date, any_value(d.daily_units) daily_units, any_value(d.daily_revenue) daily_revenue, any_value(d.had_promo) had_promo,
 {_ratio('coalesce(sum(e.daily_units) filter (where e.transaction_date > d.transaction_date - 7), 0)', 'least(7, any_value(d.age))')} units_7d_avg,
 {_ratio('coalesce(sum(e.daily_units), 0)', 'least(28, any_value(d.age))')} units_28d_avg,
 {_ratio('coalesce(sum(e.daily_revenue) filter (where e.transaction_date > d.transaction_date - 7), 0)', 'least(7, any_value(d.age))')} revenue_7d_avg,
 sum(e.had_promo) filter (where e.transaction_date > d.transaction_date - 7) promo_running_count,
 case when any_value(d.age) > 7 then {_ratio('(coalesce(any_value(d.daily_units), 0) - coalesce(sum(e.daily_units) filter (where e.transaction_date = d.transaction_date - 7), 0))', 'coalesce(sum(e.daily_units) filter (where e.transaction_date = d.transaction_date - 7), 0)')} end wow_growth,
 extract(dow from d.transaction_date) day_of_week, extract(month from d.transaction_date) month_num, case when extract(dow from d.transaction_date) in (6, 7) then 1 else 0 end is_weekend
 from (select *, transaction_date - min(transaction_date) over (partition by store_key, upc) + 1 age from day_sale where transaction_date is not null) d
 join day_sale e on e.store_key is not distinct from d.store_key and e.upc is not distinct from d.upc and e.transaction_date between d.transaction_date - 27 and d.transaction_date
 group by d.store_key, d.upc, d.transaction_date""", _FEATURE_SPEC),
    "refreshed_promo_lift": (_lift("_merged"), _LIFT_SPEC),
    "refreshed_availability": (_availability("_merged"), _SHELF_SPEC),
    "refreshed_promotions": ("select * from promo_fact", _PROMO_FACT_SPEC),
    "applied_order_changes": ("select record_id, material_number, order_qty, net_value, plant, order_type from raw_orders", dict(record_id=TEXT, material_number=TEXT, order_qty=TEXT, net_value=TEXT, plant=TEXT, order_type=TEXT)),
    "check_repeated_inventory_keys": ("select inventory_sk, count(*) as rows from stock_fact where inventory_sk is not null group by inventory_sk having count(*) > 1", dict(inventory_sk=TEXT, rows=WHOLE)),
    "check_missing_sale_dates": ("select pos_sale_sk, store_key, upc, units_sold from pos_fact where transaction_date is null", dict(pos_sale_sk=TEXT, store_key=WHOLE, upc=TEXT, units_sold=NUMBER)),
    "check_missing_promo_starts": ("select promo_id, retailer_code, end_date from promo_fact where start_date is null", dict(promo_id=TEXT, retailer_code=TEXT, end_date=TEXT)),
    "check_negative_revenue": ("select pos_sale_sk, store_key, upc, revenue from pos_fact where revenue < 0", dict(pos_sale_sk=TEXT, store_key=WHOLE, upc=TEXT, revenue=NUMBER)),
    "check_orphan_promos": ("select c.material_number, count(*) as rows from promo_fact c where c.material_number is not null and c.material_number not in (select material_number from dim_product) group by 1", dict(material_number=TEXT, rows=WHOLE)),
    "check_orphan_promos_or_null": ("select c.material_number, count(*) as rows from promo_fact c left join dim_product p on p.material_number = c.material_number where p.material_number is null group by 1", dict(material_number=TEXT, rows=WHOLE)),
    "check_inverted_promos": ("select promo_id, start_date, end_date from promo_fact where start_date > end_date", dict(promo_id=TEXT, start_date=TEXT, end_date=TEXT)),
    "quality_report": (_report(_MODEL_LINES), _REPORT_SPEC),
    "assertion_report": (_report(_ASSERTION_LINES), _REPORT_SPEC),
}


_ORACLES["refreshed_conformed_sales"] = _ORACLES["conformed_sales"]


def _definition(name: str) -> str | None:
    if name in FEEDS:
        return re.sub(r"\{(\w+)\}", r"\1", FEEDS[name])
    return STEPS.get(name)


def _with(sql: str) -> str:
    """``sql`` behind the WITH list of every step and feed it needs, in order of use."""
    found: dict[str, str] = {}

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_]+\b", text)):
            body = _definition(word)
            if body is not None and word not in found:
                visit(body)
                found[word] = body

    visit(sql)
    steps = ", ".join(f"{name} as ({body})" for name, body in found.items())
    return f"with {steps} {sql}" if steps else sql


def oracle(name: str) -> str:
    sql, spec = _ORACLES[name]
    typed = ", ".join(f"cast({column} as {kind}) as {column}" for column, kind in spec.items())
    return _with(f"select {typed} from ({sql}) result")


def oracles() -> dict[str, str]:
    return {name: oracle(name) for name in _ORACLES}
