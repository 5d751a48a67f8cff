"""Change sets applied to tables, and joins kept up to date, against plain recomputation."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.operators import deltas
from shelfline.operators import upsert as upsert_module
from shelfline.operators.changes import snapshot_diff
from shelfline.operators.deltas import Delta, apply_changes, join_delta, merge_changes, missing_deletes
from shelfline.sources.tables import read_table

ROW = "k string, day date, units int"


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, d string, units int").selectExpr("k", "CAST(d AS date) day", "units").select("k", "day", "units")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


rows_of = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["2024-01-01", "2024-02-01", None]), st.sampled_from([1, 2, None])), max_size=8
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_of, rows_of)
def test_old_and_changes_give_new(spark, old, new):
    a, b = table(spark, old), table(spark, new)
    changes = snapshot_diff(a, b, ["k"])
    assert bag(apply_changes(a, changes)) == bag(b)
    assert missing_deletes(a, changes).count() == 0


def test_deletes_without_a_row_are_reported(spark, tmp_path):
    a, b = table(spark, [("a", "2024-01-01", 1)] * 3), table(spark, [])
    changes = snapshot_diff(a, b, ["k"])
    assert [r["copies"] for r in missing_deletes(table(spark, [("a", "2024-01-01", 1)]), changes).collect()] == [2]
    path = str(tmp_path / "t")
    merge_changes(spark, path, snapshot_diff(b, table(spark, [("a", "2024-01-01", 1)]), ["k"]), "day", ["k"])
    with pytest.raises(deltas.ChangesDontFit):
        merge_changes(spark, path, changes, "day", ["k"])
    assert read_table(spark, path).count() == 1


def test_many_copies_are_spelled_out(spark):
    old, new = table(spark, [("a", "2024-01-01", 1)]), table(spark, [("a", "2024-01-01", 1)] * 25_003)
    assert apply_changes(old, snapshot_diff(old, new, ["k"])).count() == 25_003


def test_stored_table_follows_its_source(spark, tmp_path):
    path = str(tmp_path / "t")
    states = [
        [("a", "2024-01-01", 1), ("a", "2024-01-01", 1), ("b", "2024-02-01", 2), ("c", None, 3)],
        [("a", "2024-01-01", 1), ("b", "2024-02-01", 9), ("d", "2024-03-01", 1), ("c", None, 3)],
        [("d", "2024-03-01", 1)],  # two folders lose all rows
        [("d", "2024-03-01", 1), ("e", None, 5)],
    ]
    before = table(spark, [])
    for i, rows in enumerate(states):
        after = table(spark, rows)
        changes = snapshot_diff(before, after, ["k"])
        assert merge_changes(spark, path, changes, "day", ["k"], version=str(i)) == ("merged" if i else "created")
        assert merge_changes(spark, path, changes, "day", ["k"], version=str(i)) == "skipped"
        assert bag(read_table(spark, path).select("k", "day", "units")) == bag(after)
        before = after


@pytest.mark.parametrize("at", ["before", "after"])
def test_a_merge_of_changes_that_died_is_completed(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "t")
    old, new = table(spark, [("a", "2024-01-01", 1), ("b", "2024-02-01", 2)]), table(spark, [("b", "2024-02-01", 3)])
    merge_changes(spark, path, snapshot_diff(table(spark, []), old, ["k"]), "day", ["k"], version="0")
    whole = upsert_module.write_clustered

    def dying(*args, **kwargs):
        if at == "after":
            whole(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(upsert_module, "write_clustered", dying)
    changes = snapshot_diff(old, new, ["k"])
    with pytest.raises(RuntimeError):
        merge_changes(spark, path, changes, "day", ["k"], version="1")
    monkeypatch.setattr(upsert_module, "write_clustered", whole)
    assert merge_changes(spark, path, changes, "day", ["k"], version="1") == "skipped"  # finished, and not applied twice
    assert bag(read_table(spark, path).select("k", "day", "units")) == bag(new)


def test_untouched_folders_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    old = table(spark, [(str(i), f"2024-01-{i % 28 + 1:02d}", i) for i in range(56)])
    merge_changes(spark, path, snapshot_diff(table(spark, []), old, ["k"]), "day", ["k"])
    import glob

    before = {f for f in glob.glob(f"{path}/*/*.parquet") if "day=2024-01-05" not in f}
    changes = snapshot_diff(old, old.withColumn("units", F.when(F.col("k") == "4", -1).otherwise(F.col("units"))), ["k"])
    merge_changes(spark, path, changes, "day", ["k"])
    assert {f for f in glob.glob(f"{path}/*/*.parquet") if "day=2024-01-05" not in f} == before


sides = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["2024-01-01"]), st.integers(1, 3)), max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sides, sides, sides, sides, st.sampled_from(["inner", "left"]))
def test_join_delta_equals_recomputation(spark, l0, l1, r0, r1, how):
    left, new_left = table(spark, l0), table(spark, l1)
    old_right, new_right = (table(spark, r).select("k", F.col("units").alias("price")) for r in (r0, r1))

    def join(a, b):
        return a.join(b, "k", how).select("k", "units", "price")

    d_left, d_right = Delta.between(left, new_left, ["k"]), Delta.between(old_right, new_right, ["k"])
    found = join_delta(left, d_left, old_right, new_right, d_right, ["k"], join)
    assert bag(apply_changes(join(left, old_right), found.changes(["k"]))) == bag(join(new_left, new_right))
