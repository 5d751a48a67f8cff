"""Seed rows. Fixed values."""

from datetime import date

from pyspark.sql import functions as F

from shelfline import schemas

PRODUCTS = [
    ("MAT-001", "028000000012", "Sunrise Classic Coffee 200g", "Sunrise", "Beverages", "Coffee", "0.200", 1, "32.50"),
    ("MAT-002", "028000000029", "ChocoCrunch Bar 41.5g", "ChocoCrunch", "Confectionery", "Chocolate Bars", "0.0415", 1, "18.00"),
    ("MAT-003", "028000000036", "PetPrime Chicken 3.5lb", "PetPrime", "Pet Care", "Dry Dog Food", "1.588", 1, "6.80"),
    ("MAT-004", "028000000043", "QuickBite Instant Noodles 5pk", "QuickBite", "Food", "Instant Noodles", "0.350", 5, "4.20"),
    ("MAT-005", "028000000050", "CrystalSpring Sparkling 750ml", "CrystalSpring", "Beverages", "Water", "0.750", 1, "2.40"),
    ("MAT-006", "028000000067", "Sunrise Gold Roast 100g", "Sunrise", "Beverages", "Coffee", "0.100", 1, "55.00"),
    ("MAT-007", "028000000074", "ChocoCrunch Chunky 50g", "ChocoCrunch", "Confectionery", "Chocolate Bars", "0.050", 1, "16.00"),
    ("MAT-008", "028000000081", "PetPrime Gourmet 85g", "PetPrime", "Pet Care", "Wet Cat Food", "0.085", 1, "12.50"),
]
STORES = [
    (1, "WMT", "Walmart", "WMT-4201", "Walmart Supercenter #4201", "Bentonville", "AR", "South"),
    (2, "WMT", "Walmart", "WMT-4502", "Walmart Supercenter #4502", "Dallas", "TX", "South"),
    (3, "WMT", "Walmart", "WMT-3108", "Walmart Supercenter #3108", "Chicago", "IL", "Midwest"),
    (4, "KRO", "Kroger", "KRO-0531", "Kroger #531", "Cincinnati", "OH", "Midwest"),
    (5, "KRO", "Kroger", "KRO-0842", "Kroger #842", "Atlanta", "GA", "South"),
    (6, "TGT", "Target", "TGT-1892", "Target #1892", "Minneapolis", "MN", "Midwest"),
    (7, "TGT", "Target", "TGT-2104", "Target #2104", "Los Angeles", "CA", "West"),
]
RATES = [
    ("2024-11-01", "USD", "1.000000"), ("2024-11-01", "CAD", "0.721000"),
    ("2024-11-01", "EUR", "1.084000"), ("2024-11-01", "GBP", "1.262000"),
    ("2024-12-01", "USD", "1.000000"), ("2024-12-01", "CAD", "0.718000"),
    ("2024-12-01", "EUR", "1.079000"), ("2024-12-01", "GBP", "1.258000"),
]
ORDERS = [
    ("SO-2024-000001", "1000", "10", "MAT-001", "PL01", "CUST-R01", "20241101", "20241103", "500", "EA", "3250.00", "USD", "ZSTD"),
    ("SO-2024-000002", "1000", "10", "MAT-002", "PL01", "CUST-R01", "20241101", "20241103", "2000", "EA", "1494.00", "USD", "ZSTD"),
    ("SO-2024-000003", "1000", "10", "MAT-003", "PL02", "CUST-R02", "20241101", "20241104", "300", "EA", "3240.00", "USD", "ZSTD"),
    ("SO-2024-000004", "1000", "10", "MAT-005", "PL01", "CUST-R03", "20241102", "20241105", "1200", "EA", "2160.00", "USD", "ZSTD"),
    ("SO-2024-000005", "1000", "10", "MAT-001", "PL01", "CUST-R02", "20241102", "20241105", "750", "EA", "4875.00", "USD", "ZSTD"),
    ("SO-2024-000006", "1000", "20", "MAT-004", "PL03", "CUST-R01", "20241103", "20241106", "4000", "EA", "5880.00", "USD", "ZPRM"),
    ("SO-2024-000007", "1000", "10", "MAT-006", "PL01", "CUST-R03", "20241103", "20241106", "200", "EA", "1100.00", "USD", "ZSTD"),
    ("SO-2024-000008", "1000", "10", "MAT-007", "PL01", "CUST-R02", "20241104", "20241107", "1500", "EA", "1200.00", "USD", "ZSTD"),
]
POS = [
    ("WMT", "WMT-4201", "028000000012", "2024-11-01", "45", "292.50", "USD", "N"),
    ("WMT", "WMT-4201", "028000000029", "2024-11-01", "120", "179.40", "USD", "Y"),
    ("WMT", "WMT-4502", "028000000012", "2024-11-01", "38", "247.00", "USD", "N"),
    ("WMT", "WMT-4502", "028000000050", "2024-11-01", "95", "171.00", "USD", "N"),
    ("WMT", "WMT-3108", "028000000036", "2024-11-01", "22", "237.60", "USD", "N"),
    ("KRO", "KRO-0531", "028000000012", "11/01/2024", "30", "195.00", "USD", "N"),
    ("KRO", "KRO-0531", "028000000043", "11/01/2024", "85", "124.95", "USD", "Y"),
    ("KRO", "KRO-0842", "028000000074", "11/01/2024", "60", "89.40", "USD", "N"),
    ("TGT", "TGT-1892", "028000000012", "20241101", "52", "338.00", "USD", "N"),
    ("TGT", "TGT-1892", "028000000081", "20241101", "40", "42.50", "USD", "N"),
    ("TGT", "TGT-2104", "028000000050", "20241101", "110", "198.00", "USD", "Y"),
    ("WMT", "WMT-4201", "028000000012", "2024-11-02", "52", "338.00", "USD", "N"),
    ("WMT", "WMT-4201", "028000000029", "2024-11-02", "95", "141.60", "USD", "N"),
    ("KRO", "KRO-0531", "028000000012", "11/02/2024", "28", "182.00", "USD", "N"),
    ("TGT", "TGT-1892", "028000000012", "20241102", "48", "312.00", "USD", "N"),
]
INVENTORY = [
    ("WMT", "WMT-4201", "028000000012", "2024-11-01", "120", "50", "200"),
    ("WMT", "WMT-4201", "028000000029", "2024-11-01", "350", "100", "0"),
    ("WMT", "WMT-4502", "028000000012", "2024-11-01", "85", "50", "200"),
    ("WMT", "WMT-3108", "028000000036", "2024-11-01", "15", "0", "100"),
    ("KRO", "KRO-0531", "028000000012", "2024-11-01", "60", "30", "150"),
    ("KRO", "KRO-0531", "028000000043", "2024-11-01", "200", "0", "0"),
    ("TGT", "TGT-1892", "028000000012", "2024-11-01", "0", "75", "200"),
    ("TGT", "TGT-2104", "028000000050", "2024-11-01", "5", "0", "500"),
]
PROMOS = [
    ("PRM-2024-001", "Holiday Coffee Blitz", "WMT", "MAT-001", "2024-11-01", "2024-11-14", "TPR", "15", "25000"),
    ("PRM-2024-002", "ChocoCrunch BOGO Nov", "WMT", "MAT-002", "2024-11-01", "2024-11-07", "BOGO", "50", "18000"),
    ("PRM-2024-003", "QuickBite Family Pack Deal", "KRO", "MAT-004", "2024-11-01", "2024-11-10", "MULTI_BUY", "20", "12000"),
    ("PRM-2024-004", "CrystalSpring Sparkling Holiday", "TGT", "MAT-005", "2024-11-01", "2024-11-21", "DISPLAY", "10", "8000"),
]

LOADED = "2024-11-05 08:00:00"


def frame(spark, schema, rows, **extra):
    """Rows given as text for the leading columns, cast to the schema; missing columns from ``extra`` or null."""
    names = schema.fieldNames()[: len(rows[0])] if rows else schema.fieldNames()
    text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    df = spark.createDataFrame(text, ", ".join(f"`{n}` string" for n in names))
    for name in schema.fieldNames():
        if name not in names:
            df = df.withColumn(name, F.lit(extra.get(name)).cast("string"))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def landing(spark, schema, rows, loaded=LOADED, file="feed.csv"):
    return frame(spark, schema, rows, _file_name=file, _loaded_at=loaded)


def seed_tables(spark):
    return {
        "dim_product": frame(
            spark, schemas.DIM_PRODUCT, PRODUCTS,
            effective_from=str(date(2024, 1, 1)), effective_to="9999-12-31", is_current="true",
        ),
        "dim_store": frame(spark, schemas.DIM_STORE, STORES, country="US"),
        "dim_fx": frame(spark, schemas.DIM_FX, RATES),
        "raw_orders": landing(spark, schemas.RAW_ORDERS, ORDERS),
        "raw_pos": landing(spark, schemas.RAW_POS, POS),
        "raw_inventory": landing(spark, schemas.RAW_INVENTORY, INVENTORY),
        "raw_promo": landing(spark, schemas.RAW_PROMO, PROMOS),
    }
