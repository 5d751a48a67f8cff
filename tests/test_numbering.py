"""Lasting numbers, found layouts and declared columns."""

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import numbering
from shelfline.operators.layouts import find_layouts
from shelfline.plans import staging
from shelfline.sources import tables


def keyed(spark, *keys):
    return spark.createDataFrame([(k, p, "x") for k, p in keys], "k string, p int, other string")


def numbers(df):
    return {(r.k, r.p): r.n for r in df.collect()}


def test_numbers_stay_and_new_keys_get_the_next(spark, tmp_path):
    path = str(tmp_path / "numbers")
    first = numbers(numbering.allocate(keyed(spark, ("b", 1), ("d", None), ("b", 1)), path, "n", ["k", "p"], start=10))
    assert first == {("b", 1): 11, ("d", None): 12}
    second = numbers(numbering.allocate(keyed(spark, ("a", 1), ("d", None), ("c", 2)), path, "n", ["k", "p"]))
    assert second == first | {("a", 1): 13, ("c", 2): 14}
    assert numbers(numbering.allocate(keyed(spark, ("a", 1)), path, "n", ["k", "p"])) == second
    found = numbering.with_numbers(keyed(spark, ("d", None), ("a", 1), ("d", None)), spark.read.parquet(f"{path}/keys").drop("load"), ["k", "p"])
    assert found.columns == ["n", "k", "p", "other"] and sorted(r.n for r in found.collect()) == [12, 12, 13]


def test_a_load_that_died_gives_its_numbers_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "numbers")
    numbering.allocate(keyed(spark, ("a", 1)), path, "n", ["k", "p"])
    whole = numbering.overwrite

    def dying(df, target, *args):
        if "/ranges/" in target:
            raise RuntimeError("lost")
        return whole(df, target, *args)

    monkeypatch.setattr(numbering, "overwrite", dying)
    with pytest.raises(RuntimeError):
        numbering.allocate(keyed(spark, ("b", 1), ("c", 1)), path, "n", ["k", "p"])
    monkeypatch.setattr(numbering, "overwrite", whole)
    # The folder of the load that died doesn't count; its keys are dealt with anew.
    assert numbers(numbering.allocate(keyed(spark, ("c", 1)), path, "n", ["k", "p"])) == {("a", 1): 1, ("c", 1): 2}
    assert numbers(numbering.allocate(keyed(spark, ("b", 1)), path, "n", ["k", "p"])) == {("a", 1): 1, ("c", 1): 2, ("b", 1): 3}


def test_no_keys(spark, tmp_path):
    assert numbering.allocate(keyed(spark), str(tmp_path / "numbers"), "n", ["k", "p"]).count() == 0


def test_layouts_of_sources(spark):
    texts = {
        "A": ["2024-01-31", "2024-02-01", "bad", None], "B": ["01.02.2024", "31.12.2024"], "C": ["01/02/2024", "03/04/2024"], "D": ["13/02/2024", "01/02/2024"],
        "E": ["nothing"], None: ["20240131"],
    }
    raw = spark.createDataFrame([(s, t) for s, own in texts.items() for t in own], "retailer_code string, d string")
    found = {r.retailer_code: (r.layout, r.texts, r.fits, r.ambiguous) for r in find_layouts(raw, "d").collect()}
    assert found == {
        "A": ("yyyy-MM-dd", 3, 2, False), "B": ("dd.MM.yyyy", 2, 2, False), "C": ("MM/dd/yyyy", 2, 2, True), "D": ("dd/MM/yyyy", 2, 2, False),
        "E": (None, 1, 0, False), None: ("yyyyMMdd", 1, 1, False),
    }


def test_a_third_layout_is_read_once_found(spark):
    raw = tables.conform(
        spark.createDataFrame([("X", "s", "u", "31.12.2024", "5"), ("X", "s", "u", "01.12.2024", "5"), ("WMT", "s", "u", "2024-05-06", "5")], "retailer_code string, store_id string, upc string, snapshot_date string, on_hand_qty string")
        .withColumns({c: F.lit("1") for c in ("in_transit_qty", "on_order_qty", "_file_name")}).withColumn("_loaded_at", F.lit("2024-01-01")),
        schemas.RAW_INVENTORY,
    )
    assert staging.stage_inventory(raw).count() == 1
    found = find_layouts(raw, "snapshot_date")
    days = [str(r.snapshot_date) for r in staging.stage_inventory(raw, found).orderBy("snapshot_date").collect()]
    assert days == ["2024-05-06", "2024-12-01", "2024-12-31"]


def test_declared_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, "R", "s1"), (2, None, "s2"), (3, None, None)], "store_key long, retailer_code string, store_id string")
    for c in schemas.DIM_STORE.names[3:]:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit("x"))
    rows = rows.withColumn("retailer_name", F.lit("n"))
    lacking = {r.store_key: r.missing for r in tables.lacking_required(rows, schemas.DIM_STORE).collect()}
    assert lacking == {2: "retailer_code", 3: "retailer_code,store_id"}
    assert tables.overwrite(rows.where("store_key = 1"), str(tmp_path / "good"), schemas.DIM_STORE) == 1
    with pytest.raises(Exception, match="declared as never null"):
        tables.overwrite(rows, str(tmp_path / "bad"), schemas.DIM_STORE)
