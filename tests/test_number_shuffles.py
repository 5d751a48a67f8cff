"""Numbering shuffles its rows once more only for rows with many copies."""

from shelfline.functions import keys


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_with_few_copies_are_not_dealt_again(spark):
    rows = spark.range(500).unionAll(spark.range(100))
    found = keys.number_rows(rows, "n", ["id"], 10)
    assert "RebalancePartitions" not in plan(found)
    assert sorted((r["n"], r["id"]) for r in found.collect()) == [(11 + i, k) for i, k in enumerate(sorted([*range(500), *range(100)]))]


def test_rows_with_many_copies_are_dealt_to_tasks(spark):
    rows = spark.range(25_000).selectExpr("1L id")
    found = keys.number_rows(rows, "n", ["id"])
    assert "RebalancePartitions" in plan(found)
    assert found.agg({"n": "max"}).first()[0] == 25_000 == found.select("n").distinct().count()
