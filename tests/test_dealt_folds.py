"""Facts folded where their rows have been dealt, and what is written of them."""

import glob

import pytest
from pyspark.sql import functions as F

from shelfline.operators import upsert as upsert_module
from shelfline.operators.upsert import spread_evenly, stored_mark, upsert
from shelfline.plans import build
from shelfline.sources.tables import read_table, write_clustered

SALE = "k string, upc string, day date, units int, _loaded_at timestamp_ntz"


def sales(spark, *rows):
    text = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], "a string, b string, c string, d string, e string")
    return text.selectExpr("a AS k", "b AS upc", "CAST(c AS date) day", "CAST(d AS int) units", "CAST(e AS timestamp_ntz) _loaded_at")


def content(df):
    return sorted(map(str, df.select("k", "upc", "day", "units", "_loaded_at").collect()))


@pytest.mark.parametrize("mode", ["merge", "full"])
def test_a_key_on_several_dealt_values_is_still_folded(spark, tmp_path, mode):
    """``a-b`` + ``c`` and ``a`` + ``b-c`` make the same key, though the column they are dealt by differs."""
    rows = sales(
        spark, ("x", "1", "2024-01-01", 1, "2024-01-02"), ("x", "2", "2024-01-01", 2, "2024-01-03"), ("y", "1", "2024-01-01", 3, "2024-01-02"),
        ("y", "1", "2024-01-01", 4, "2024-01-02"), (None, "1", "2024-01-01", 5, "2024-01-09"), (None, "1", "2024-01-01", 5, "2024-01-09"),
    )
    plain, dealt = str(tmp_path / "plain"), str(tmp_path / "dealt")
    want = upsert(spark, plain, rows, "k", "day", mode=mode)
    got = upsert(spark, dealt, rows, "k", "day", mode=mode, dealt_by="upc")
    assert content(read_table(spark, dealt)) == content(read_table(spark, plain)) and read_table(spark, dealt).count() == 2
    assert (got.written, got.null_keys, got.rejects.count()) == (want.written, want.null_keys, 2) == (2, 2, 2)
    assert stored_mark(spark, dealt) == stored_mark(spark, plain)


def test_rows_dealt_by_a_join_are_not_shuffled_by_key(spark, tmp_path, monkeypatch):
    plans, whole = [], upsert_module.write_stage

    def seen(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        whole(df, path)

    monkeypatch.setattr(upsert_module, "write_stage", seen)
    rows = sales(spark, *[(f"k{i}", str(i % 3), "2024-01-01", i, "2024-01-02") for i in range(9)]).repartition("upc")
    upsert(spark, str(tmp_path / "t"), rows, "k", "day", dealt_by="upc")
    assert len(plans) == 1 and "hashpartitioning(upc" in plans[0] and "hashpartitioning(k" not in plans[0]


def test_a_hot_product_is_not_dealt(spark):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("upc"))
    hot = rows.unionByName(spark.range(2000).select(F.lit("hot").alias("upc")))
    assert spread_evenly(rows, "upc", few=0) and not spread_evenly(hot, "upc", few=0)
    assert spread_evenly(hot, "upc") and spread_evenly(rows.limit(0), "upc", few=0)


def test_facts_are_dealt_unless_a_product_is_hot(spark, tmp_path, monkeypatch):
    given = []
    monkeypatch.setattr(build, "upsert", lambda *args, **how: given.append(how["dealt_by"]))
    landed = sales(spark, ("x", "1", "2024-01-01", 1, "2024-01-02")).withColumnsRenamed({"k": "pos_sale_sk", "day": "transaction_date"})
    for even in (True, False):
        monkeypatch.setattr(build, "spread_evenly", lambda rows, column, even=even: even)
        build.merge_fact(spark, str(tmp_path), "fct_pos_sales", landed, lambda rows: rows)
    assert given == ["upc", None]


def test_hashed_keys_of_any_text_survive_packing(spark, tmp_path):
    texts = ["d41d8cd98f00b204e9800998ecf8427e", "D41D8CD98F00B204E9800998ECF8427E", "abc", "ab", "", "zz", None]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "pos_sale_sk string, part int")
    write_clustered(rows, str(tmp_path / "t"), "part", ["pos_sale_sk"])
    assert [r.pos_sale_sk for r in read_table(spark, str(tmp_path / "t")).orderBy("part").collect()] == texts
    assert all(f.endswith(".zstd.parquet") for f in glob.glob(f"{tmp_path}/t/part=*/*.parquet"))
