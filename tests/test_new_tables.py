"""Kept gold tables at their first load."""

import pytest
from pyspark.sql import functions as F

from shelfline.plans import maintain
from shelfline.sources.tables import read_table


def test_a_new_table_of_daily_sums_is_not_counted_row_by_row(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("1", "R", "2024-01-05", 2, 4)] * 2, "upc string, retailer_code string, d string, units_sold int, r int")
    rows = rows.select("upc", "retailer_code", F.col("d").cast("date").alias("transaction_date"), "units_sold", F.col("r").cast("decimal(18,2)").alias("revenue_usd"))
    monkeypatch.setattr(maintain.Delta, "net", lambda self: pytest.fail("counted"))
    path = str(tmp_path / "daily")
    assert maintain.refresh_daily_sales(spark, path, maintain.Delta(rows, rows.limit(0))) == "created"
    assert [(r.units, r.all_rows) for r in read_table(spark, path).collect()] == [(4, 2)]
