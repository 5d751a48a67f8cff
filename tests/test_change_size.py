"""Change sets as large as their table: counted in one shuffle, never broadcast, read once."""

from pyspark.sql import functions as F

from shelfline.operators import lookups
from shelfline.operators.changes import snapshot_diff
from shelfline.operators.deltas import Delta, apply_changes, merge_changes
from shelfline.sources.tables import read_table, stored


def wide(spark, rows, first=0):
    """Rows of about 150 bytes, every tenth of them twice."""
    ids = spark.range(first, first + rows, numPartitions=4)
    ids = ids.unionByName(ids.where("id % 10 = 0"))
    return ids.select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).alias("part"), F.repeat(F.lit("x"), 100).alias("text"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_deletes_are_counted_without_a_join(spark):
    target = stored(wide(spark, 200_000), "target")
    changes = snapshot_diff(target, wide(spark, 1000, 199_500), ["k"])
    after = apply_changes(target, changes)
    assert "Join" not in plan(after) and "BroadcastExchange" not in plan(after)
    assert snapshot_diff(after, wide(spark, 1000, 199_500), ["k"]).count() == 0


def test_many_deletes_of_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old, new = stored(wide(spark, 200_000), "old"), stored(wide(spark, 1000, 199_500), "new")
    nothing = old.limit(0)
    assert merge_changes(spark, path, Delta(old, nothing).net(), "part", ["k"]) == "created"
    assert merge_changes(spark, path, Delta(new, old).net(), "part", ["k"]) == "merged"
    assert snapshot_diff(read_table(spark, path).select(*new.columns), new, ["k"]).count() == 0


def test_a_table_the_driver_could_not_hold_several_times_is_not_broadcast(spark):
    table = wide(spark, 600_000)
    found = spark.range(10).select(F.concat(F.lit("k"), "id").alias("k")).join(lookups.if_small(table), "k")
    assert "broadcast" not in found._jdf.queryExecution().analyzed().toString()


def test_a_change_set_is_computed_once(spark):
    target = stored(wide(spark, 50), "target")
    # Its rows come from a range, the target's from files.
    after = apply_changes(target, snapshot_diff(wide(spark, 50), wide(spark, 20, 40), ["k"]))
    assert "Range" not in plan(after)
    assert snapshot_diff(after, wide(spark, 20, 40), ["k"]).count() == 0
