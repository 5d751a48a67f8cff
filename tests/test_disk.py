"""What steps leave on disk."""

import re
import time
from itertools import takewhile

from pyspark.sql import functions as F

from shelfline.catalog import queries
from shelfline.catalog.tables import Tables
from shelfline.operators.deltas import apply_changes
from shelfline.sources.tables import CLEANUP, overwrite, read_table, stored


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if "shuffle_" in f}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landed_json_is_packed(spark, sf_dir):
    t = Tables(spark, sf_dir)
    found = queries.raw_pos(t)
    assert all(f.endswith(".json.gz") for f in found.inputFiles())
    assert found.exceptAll(t.raw_pos).isEmpty() and found.count() == t.raw_pos.count()


def test_a_written_step_keeps_no_shuffle_files(spark, tmp_path):
    def counted():
        return spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count(F.lit(1)).alias("n"))

    for write in (lambda: stored(counted(), "counted"), lambda: overwrite(counted(), str(tmp_path / "t"))):
        before = shuffle_files(spark)
        write()
        until = time.time() + 5
        while (left := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.1)
        assert not left and spark.conf.get(CLEANUP) == "false"
    assert read_table(spark, str(tmp_path / "t")).count() == 1000


def test_rows_that_come_are_not_counted(spark):
    """Only the table and the rows to delete are shuffled."""
    target = stored(spark.range(400_000, numPartitions=4).select("id", F.repeat(F.lit("x"), 50).alias("text")), "target")
    gone = target.where("id < 300000").select(F.lit("DELETE").alias("change"), F.lit(1).cast("bigint").alias("copies"), "id", "text")
    # One row comes that goes as well, twice; one to delete isn't there.
    some = spark.createDataFrame([("INSERT", 2, 7, "x" * 50), ("INSERT", 3, 900_000, "new"), ("DELETE", 1, 900_000, "new"), ("DELETE", 5, 350_000, "x" * 50)], "change string, copies bigint, id bigint, text string")
    after = apply_changes(target, gone.unionByName(some))
    lines = plan(after).splitlines()
    (top,) = (i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    depth = lines[top].index("Exchange")
    below = list(takewhile(lambda line: re.search(r"\w", line).start() > depth, lines[top + 1 :]))
    assert any("DELETE" in line for line in below) and not any("INSERT" in line for line in below)
    assert after.count() == 100_000 - 1 + 2 + 3
    assert after.where("id = 7").count() == 2 and after.where("id = 900000").count() == 3 and after.where("id = 350000").isEmpty()
