"""Declared schemas of the landing, bronze, reference and silver tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, DATE, FLAG, KEY, STAMP = StringType(), DateType(), BooleanType(), LongType(), TimestampNTZType()
QTY0 = DecimalType(18, 0)
QTY3 = DecimalType(18, 3)
MONEY = DecimalType(18, 2)
RATE = DecimalType(18, 6)
WEIGHT = DecimalType(10, 4)
PERCENT = DecimalType(5, 2)


def _table(required: tuple[str, ...] = (), **columns: DataType) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in columns.items()])


def _landing(*names: str) -> StructType:
    return _table(**dict.fromkeys(names, TEXT), _file_name=TEXT, _loaded_at=STAMP)


LINEAGE = ("_file_name", "_loaded_at")

RAW_ORDERS = _landing(
    "record_id", "sales_org", "distribution_channel", "material_number", "plant",
    "customer_number", "order_date", "delivery_date", "order_qty", "order_qty_uom",
    "net_value", "currency", "order_type",
)
RAW_POS = _landing(
    "retailer_code", "store_id", "upc", "transaction_date", "units_sold", "revenue",
    "currency_code", "promo_flag",
)
RAW_INVENTORY = _landing(
    "retailer_code", "store_id", "upc", "snapshot_date", "on_hand_qty", "in_transit_qty",
    "on_order_qty",
)
RAW_PROMO = _landing(
    "promo_id", "promo_name", "retailer_code", "material_number", "start_date", "end_date",
    "promo_mechanic", "discount_pct", "trade_spend_usd",
)

_PRODUCT = dict(
    material_number=TEXT, upc=TEXT, product_name=TEXT, brand=TEXT, category=TEXT,
    sub_category=TEXT, unit_weight_kg=WEIGHT, pack_size=DecimalType(5, 0),
    avg_price_per_kg=DecimalType(10, 2), effective_from=DATE, effective_to=DATE,
    is_current=FLAG,
)
DIM_PRODUCT = _table(("material_number",), **_PRODUCT)
DIM_STORE = _table(
    ("retailer_code", "store_id"),
    store_key=KEY, retailer_code=TEXT, retailer_name=TEXT, store_id=TEXT, store_name=TEXT,
    city=TEXT, state=TEXT, region=TEXT, country=TEXT,
)
DIM_FX = _table(("rate_date", "currency_code"), rate_date=DATE, currency_code=TEXT, rate_to_usd=RATE)

ORDERS_STAGED = _table(
    ("record_id",),
    record_id=TEXT, sales_org=TEXT, distribution_channel=TEXT, material_number=TEXT, plant=TEXT,
    customer_number=TEXT, order_date=DATE, delivery_date=DATE, order_qty=QTY3,
    order_qty_uom=TEXT, net_value=MONEY, currency=TEXT, order_type=TEXT,
    _source_file=TEXT, _loaded_at=STAMP, _staged_at=STAMP,
)
ORDERS_REJECTED = _table(
    record_id=TEXT, raw_order_date=TEXT, raw_order_qty=TEXT, raw_net_value=TEXT,
    material_number=TEXT, rejection_reason=TEXT, _rejected_at=STAMP,
)
POS_CLEANSED = _table(
    retailer_code=TEXT, store_key=KEY, upc=TEXT, transaction_date=DATE, units_sold=QTY0,
    revenue=MONEY, currency_code=TEXT, revenue_usd=MONEY, promo_flag=FLAG, _source_file=TEXT,
    _loaded_at=STAMP,
)
INVENTORY_CLEANSED = _table(
    retailer_code=TEXT, store_key=KEY, upc=TEXT, snapshot_date=DATE, on_hand_qty=QTY0,
    in_transit_qty=QTY0, on_order_qty=QTY0, _source_file=TEXT, _loaded_at=STAMP,
)
POS_QUALITY_LOG = _table(
    audit_timestamp=STAMP, total_rows=KEY, null_store_key_count=KEY, future_date_count=KEY,
    negative_revenue_count=KEY,
)
FCT_POS_SALES = _table(
    ("pos_sale_sk",),
    pos_sale_sk=TEXT, retailer_code=TEXT, store_key=KEY, upc=TEXT, transaction_date=DATE,
    units_sold=QTY0, revenue=MONEY, revenue_usd=MONEY, kg_sold=DecimalType(18, 4),
    promo_flag=FLAG, brand=TEXT, category=TEXT, _loaded_at=STAMP,
)
FCT_INVENTORY = _table(
    ("inventory_sk",),
    inventory_sk=TEXT, retailer_code=TEXT, store_key=KEY, upc=TEXT, snapshot_date=DATE,
    on_hand_qty=QTY0, in_transit_qty=QTY0, on_order_qty=QTY0, total_pipeline_qty=QTY0,
    _loaded_at=STAMP,
)
FCT_PROMOTIONS = _table(
    ("promo_id",),
    promo_id=TEXT, promo_name=TEXT, retailer_code=TEXT, material_number=TEXT, upc=TEXT,
    start_date=DATE, end_date=DATE, promo_mechanic=TEXT, discount_pct=PERCENT,
    trade_spend_usd=MONEY, promo_duration_days=DecimalType(5, 0), _loaded_at=STAMP,
)
DIM_PRODUCT_VERSIONS = _table(
    ("material_number", "effective_from"), product_sk=KEY, **_PRODUCT, _updated_at=STAMP
)
