"""The driver's TPC-H-like tables turned into landing feeds and reference tables.

Each text below runs unchanged in Spark and in DuckDB; names in braces stand for the
tables it reads. Whole tables are used: every line item becomes a sale, a stock
snapshot and an order line. Two thirds of the orders are sold by the nations' shops, as product lines,
one per (brand, type), so that a shop and a line meet often enough for long series. The others are sold by
suppliers, as single parts; ten suppliers make a retailer, so products, shops and retailers with sales all
grow with the tables. Lines and parts are in the product master, in two versions, and in the promotion
calendar, a part at the retailer of one of its suppliers. Some keys carry
damaged text so that each validation rule has work to do; damaged rows stay in the feed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfline import schemas
from shelfline.session import shared_dir
from shelfline.sources.tables import overwrite, read_table

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _iso(date: str) -> str:
    return _joined(date, "-", "ymd")


def _joined(date: str, separator: str, order: str) -> str:
    parts = {
        "y": f"cast(year({date}) as string)",
        "m": f"lpad(cast(month({date}) as string), 2, '0')",
        "d": f"lpad(cast(day({date}) as string), 2, '0')",
    }
    return "concat(" + f", '{separator}', ".join(parts[p] for p in order) + ")"


_RETAILER = "case n_nationkey % 3 when 0 then 'WMT' when 1 then 'KRO' else 'TGT' end"
_CURRENCY = "case l_suppkey % 4 when 0 then 'CAD' when 1 then 'EUR' when 2 then 'GBP' else 'USD' end"
_CODE = """cast(substr(p_brand, 7) as int) * 10 + case p_type when 'ECONOMY' then 0 when 'SMALL' then 1
 when 'MEDIUM' then 2 when 'PROMO' then 3 when 'STANDARD' then 4 when 'LARGE' then 5 else 6 end"""
_MATERIAL = "concat('MAT-', lpad(cast(code as string), 6, '0'))"
_PART_MATERIAL = "concat('MAT-P', lpad(cast({key} as string), 9, '0'))"
_UPC_BODY = "lpad(cast(code as string), 9, '0')"


def _supplier_retailer(key: str) -> str:
    return f"concat('R', cast(cast(floor({key} / 10) as bigint) as string))"


def _supplier_shop(key: str) -> str:
    return f"concat({_supplier_retailer(key)}, '-', lpad(cast({key} as string), 9, '0'))"


def _product_version(factor: int, first: str, last: str, current: str) -> str:
    return f"""select material_number, upc, product_name, brand, category,
 concat(category, ' ', cast(pack_size % 4 as string)) sub_category,
 cast(pack_size * {factor} as decimal(10,4)) unit_weight_kg, cast(pack_size as decimal(5,0)) pack_size,
 cast(price as decimal(10,2)) avg_price_per_kg, date '{first}' effective_from, date '{last}' effective_to,
 {current} is_current from {{product_base}}"""


def _rate(currency: str, rate: str) -> str:
    return f"select month_start rate_date, '{currency}' currency_code, cast('{rate}' as decimal(18,6)) rate_to_usd from {{order_month}}"


FEEDS: dict[str, str] = {
    "product_line": f"""select {_CODE} code, p_brand brand, p_type category, min(p_name) product_name,
 max(p_size) pack_size, max(p_retailprice) price from {{part}} group by {_CODE}, p_brand, p_type""",
    "product_base": f"""select {_MATERIAL} material_number, concat('028', {_UPC_BODY}) upc, product_name, brand, category,
 pack_size, price from {{product_line}} union all
 select {_PART_MATERIAL.format(key='p_partkey')}, concat('029', lpad(cast(p_partkey as string), 9, '0')), p_name, p_brand, p_type,
 p_size, p_retailprice from {{part}}""",
    "part_code": f"select p_partkey, {_CODE} code from {{part}}",
    "order_month": "select distinct cast(date_trunc('month', o_orderdate) as date) month_start from {orders}",
    "dim_store": f"""select cast(n_nationkey as bigint) store_key, {_RETAILER} retailer_code,
 concat({_RETAILER}, ' Stores') retailer_name,
 concat({_RETAILER}, '-', lpad(cast(n_nationkey as string), 4, '0')) store_id, n_name store_name,
 concat('City ', cast(n_nationkey as string)) city, concat('State ', cast(n_nationkey % 7 as string)) state,
 r_name region, 'US' country from {{nation}} join {{region}} on n_regionkey = r_regionkey union all
 select 1000 + s_suppkey, {_supplier_retailer('s_suppkey')}, concat({_supplier_retailer('s_suppkey')}, ' Shops'), {_supplier_shop('s_suppkey')}, s_name,
 concat('City ', cast(n_nationkey as string)), concat('State ', cast(n_nationkey % 7 as string)), r_name, 'US'
 from {{supplier}} join {{nation}} on s_nationkey = n_nationkey join {{region}} on n_regionkey = r_regionkey""",
    "dim_product": _product_version(1, "1990-01-01", "1998-06-30", "false")
    + " union all "
    + _product_version(2, "1998-07-01", "9999-12-31", "true"),
    "dim_fx": " union all ".join([_rate("USD", "1.000000"), _rate("CAD", "0.721000"), _rate("EUR", "1.084000")]),
    "placed_order": """select o_orderkey, o_orderdate, c_custkey, retailer_code, store_id from {orders}
 join {customer} on o_custkey = c_custkey join {dim_store} on c_nationkey = store_key""",
    # The hint keeps line items, the large side, out of a broadcast: the estimate for the joined orders is far too high.
    "sale": f"""select /*+ MERGE(o) */ l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate,
 o_orderdate, c_custkey, case when l_orderkey % 3 = 0 then {_supplier_retailer('l_suppkey')} else o.retailer_code end retailer_code,
 case when l_orderkey % 3 = 0 then {_supplier_shop('l_suppkey')} else o.store_id end store_id,
 case when l_orderkey % 3 = 0 then concat('029', lpad(cast(l_partkey as string), 9, '0')) else concat('028', {_UPC_BODY}) end upc
 from {{lineitem}} join {{placed_order}} o on l_orderkey = o_orderkey join {{part_code}} on l_partkey = p_partkey""",
    "part_seller": "select l_partkey, min(l_suppkey) seller from {lineitem} group by l_partkey",
    "raw_pos": f"""select case when l_orderkey % 53 = 0 then concat(' ', lower(retailer_code)) else retailer_code end retailer_code,
 store_id, case when l_orderkey % 41 = 0 then substr(upc, 1, 3) when l_orderkey % 43 = 0 then concat(substr(upc, 1, 3), '-', substr(upc, 4))
 when l_orderkey % 47 = 0 then concat('0', upc) else upc end upc,
 case when l_orderkey % 71 = 0 then 'not-a-date' when retailer_code = 'KRO' then {_joined('o_orderdate', '/', 'mdy')}
 when retailer_code = 'TGT' then {_joined('o_orderdate', '', 'ymd')} else {_iso('o_orderdate')} end transaction_date,
 case when l_orderkey % 59 = 0 then '-5' when l_orderkey % 61 = 0 then 'N/A' when l_orderkey % 103 = 0 then '1234567890123456789' else cast(cast(l_quantity as bigint) as string) end units_sold,
 case when l_orderkey % 67 = 0 then 'bad' when l_orderkey % 101 = 0 then '-12.50'
 else cast(cast(l_extendedprice as decimal(18,2)) as string) end revenue,
 {_CURRENCY} currency_code, case when l_returnflag = 'R' then 'Y' when l_returnflag = 'A' then 'N' end promo_flag,
 concat('pos_', cast(year(o_orderdate) as string), '.csv') _file_name, o_orderdate + interval 1 day _loaded_at from {{sale}}""",
    "raw_inventory": f"""select retailer_code, store_id, upc,
 case when l_orderkey % 71 = 0 then '' when l_orderkey % 3 = 0 then {_joined('l_shipdate', '/', 'mdy')} else {_iso('l_shipdate')} end snapshot_date,
 case when l_orderkey % 59 = 0 then '-1' when l_orderkey % 61 = 0 then 'none' when l_orderkey % 103 = 0 then '1234567890123456789' else cast(cast((l_quantity - 1) * 20 as bigint) as string) end on_hand_qty,
 case when l_orderkey % 61 = 0 then null else cast(l_suppkey % 40 as string) end in_transit_qty,
 cast(l_suppkey % 90 as string) on_order_qty, concat('inv_', cast(year(l_shipdate) as string), '.csv') _file_name,
 l_shipdate + interval 1 day _loaded_at from {{sale}}""",
    "promo_base": f"""select concat('PRM-', cast(code as string)) promo_id, code number, brand, category, pack_size,
 case code % 3 when 0 then 'WMT' when 1 then 'KRO' else 'TGT' end retailer_code, {_MATERIAL} material,
 cast(date '1995-02-01' + cast(code * 9 as int) as date) first_day from {{product_line}} union all
 select concat('PRM-P', cast(p_partkey as string)), p_partkey, p_brand, p_type, p_size, {_supplier_retailer('seller')},
 {_PART_MATERIAL.format(key='p_partkey')}, cast(date '1995-02-01' + cast(p_partkey % 2300 as int) as date)
 from {{part}} left join {{part_seller}} on l_partkey = p_partkey""",
    "promo_window": """select *, cast(first_day + cast(6 + pack_size % 9 - case when number % 37 = 0 then 30 else 0 end as int) as date) last_day
 from {promo_base}""",
    "raw_promo": f"""select promo_id, concat(brand, ' ', category) promo_name, retailer_code,
 case when number % 50 = 0 then 'MAT-NONE' when number % 62 = 0 then null else material end material_number,
 case when number % 41 = 0 then 'soon' else {_iso('first_day')} end start_date, {_iso('last_day')} end_date,
 case number % 2 when 0 then 'TPR' else 'DISPLAY' end promo_mechanic,
 case when number % 43 = 0 then 'half' else cast(pack_size as string) end discount_pct,
 cast(pack_size * 100 as string) trade_spend_usd, 'promo.csv' _file_name,
 cast(first_day as timestamp) _loaded_at from {{promo_window}}""",
    "raw_orders": f"""select concat('SO-', cast(l_orderkey as string), '-', cast(l_linenumber as string)) record_id,
 '1000' sales_org, case when l_suppkey % 5 = 0 then '20' else '10' end distribution_channel,
 case when l_orderkey % 89 = 0 then null else {_PART_MATERIAL.format(key='l_partkey')} end material_number,
 concat('PL0', cast(l_suppkey % 3 as string)) plant, concat('CUST-', cast(c_custkey as string)) customer_number,
 case when l_orderkey % 73 = 0 then '20241399' else {_joined('o_orderdate', '', 'ymd')} end order_date,
 {_joined('l_shipdate', '', 'ymd')} delivery_date,
 case when l_orderkey % 79 = 0 then 'x' else cast(cast(l_quantity as bigint) as string) end order_qty, 'EA' order_qty_uom,
 case when l_orderkey % 83 = 0 then '' else cast(cast(l_extendedprice as decimal(18,2)) as string) end net_value,
 {_CURRENCY} currency, l_returnflag order_type,
 concat('orders_', cast(year(o_orderdate) as string), '.csv') _file_name, o_orderdate + interval 1 day _loaded_at from {{sale}}""",
}


def reads(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", FEEDS[name])))


# Feeds that land as tables; the others only help to derive them.
LANDED = {
    "raw_orders": schemas.RAW_ORDERS,
    "raw_pos": schemas.RAW_POS,
    "raw_inventory": schemas.RAW_INVENTORY,
    "raw_promo": schemas.RAW_PROMO,
    "dim_product": schemas.DIM_PRODUCT,
    "dim_store": schemas.DIM_STORE,
    "dim_fx": schemas.DIM_FX,
}
_landed: dict[tuple[str, str, str], str] = {}


class Feeds:
    """The feeds of one data folder.

    A landed feed is derived on first use and written to the shared folder, once per
    application. Jobs then start where they do in practice, at a scan of that table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def derive(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        return self.spark.sql(FEEDS[name], **{t: self.derive(t) for t in reads(name)})

    def path(self, name: str) -> str:
        """Where a feed has landed."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _landed:
            path = shared_dir(self.spark, "feeds", uuid.uuid4().hex[:12], name)
            overwrite(self.derive(name), path, LANDED[name])
            _landed[key] = path
        return _landed[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in LANDED:
            raise AttributeError(name)
        return read_table(self.spark, self.path(name), LANDED[name])
