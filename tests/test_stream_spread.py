"""Batches of few files use all cores."""

from pyspark.sql import functions as F

from shelfline.streaming import ingest


def test_a_batch_of_one_file_is_dealt_to_all_cores(spark, tmp_path):
    path = str(tmp_path / "land")
    # A third of the rows are equal.
    spark.range(3000, numPartitions=1).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id")).write.parquet(path)
    batch = spark.read.parquet(path)
    dealt = ingest._spread(batch, max_files=1)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)
    assert dealt.columns == ["id"] and dealt.exceptAll(batch).count() == 0 == batch.exceptAll(dealt).count()


def test_a_batch_of_many_files_stays(spark, tmp_path):
    batch = spark.range(10)
    assert ingest._spread(batch) is batch
