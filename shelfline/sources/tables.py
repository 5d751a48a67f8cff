"""Parquet tables as sinks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shelfline.session import shared_dir


# Hashed keys are hex digits, of which half are redundant; Spark's default codec keeps them all.
CODEC = "zstd"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that ends within go at its end, not when the driver happens to collect its garbage.

    For writes: what they read back later is the written table. A frame that is executed once more shuffles once more.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns cast and ordered as the target table declares them."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def required_columns(schema: StructType) -> list[str]:
    """Columns declared as never null."""
    return [f.name for f in schema.fields if not f.nullable]


def conform_strictly(df: DataFrame, schema: StructType) -> DataFrame:
    """``conform``, and a job that reads a null in a column declared as never null fails."""
    found = conform(df, schema)
    checked = {c: F.coalesce(c, F.raise_error(F.lit(f"null in {c}, which is declared as never null"))) for c in required_columns(schema)}
    return found.withColumns(checked) if checked else found


def lacking_required(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows that a table of this schema can't take, with ``missing``, the declared columns they lack; typed as the table's rows."""
    wanted = required_columns(schema)
    found = conform(df, schema)
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in wanted])) if wanted else F.array().cast("array<string>")
    return found.withColumn("missing", F.array_join(names, ",")).where("missing <> ''")


def append(df: DataFrame, path: str, schema: StructType | None = None) -> int:
    return _write_counted(df if schema is None else conform_strictly(df, schema), path, "append")


def overwrite(df: DataFrame, path: str, schema: StructType | None = None) -> int:
    return _write_counted(df if schema is None else conform_strictly(df, schema), path, "overwrite")


def _write_counted(df: DataFrame, path: str, mode: str) -> int:
    """Writes and returns the row count, taken by the write itself."""
    seen = Observation()
    with shuffles_dropped(df.sparkSession):
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", CODEC).parquet(path)
    return seen.get["rows"]


def write_stage(df: DataFrame, path: str, group_rows: int | None = None) -> None:
    """A step of a job, in a folder of its own.

    ``group_rows`` is for rows of megabytes. Spark's writer looks at a row group's size every hundred rows only, and its reader holds up to
    4,096 rows of a group at once.
    """
    writer = df.write.mode("overwrite").option("compression", CODEC)
    with shuffles_dropped(df.sparkSession):
        (writer if group_rows is None else writer.option("parquet.block.row.count.limit", group_rows)).parquet(path)


def _packed(df: DataFrame, hashed: list[str]) -> DataFrame:
    """Columns of lower-case hex digits as bytes, half as long; other text stays as it is beside them."""
    for c in hashed:
        df = df.withColumn(f"_bytes_{c}", F.when(F.col(c) == F.lower(F.hex(F.unhex(c))), F.unhex(c)))
        df = df.withColumn(c, F.when(F.col(f"_bytes_{c}").isNull(), F.col(c)))
    return df


def _unpacked(df: DataFrame, hashed: list[str], columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.lower(F.hex(f"_bytes_{c}")), c) for c in hashed}).select(*columns) if hashed else df


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str],
    cluster_by: list[str],
    mode: str = "overwrite",
    only_touched: bool = False,
) -> None:
    """One folder per value of ``partition_by``, or per combination of several columns', rows sorted by ``cluster_by`` inside its files.

    The rebalance hint shuffles by folder so that a folder gets few files, and lets
    AQE cut a folder that holds far more rows than the others into several tasks.
    """
    folders = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    hashed = [f.name for f in df.schema.fields if f.name.endswith("_sk") and isinstance(f.dataType, StringType) and f.name not in folders]
    dealt = _packed(df, hashed).hint("rebalance", *folders)
    (
        _unpacked(dealt, hashed, df.columns)
        .sortWithinPartitions(*folders, *cluster_by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if only_touched else "static")
        .option("compression", CODEC)
        .partitionBy(*folders)
        .parquet(path)
    )


def folders_of(table: DataFrame, parts: DataFrame) -> list[str]:
    """Folders of a partitioned ``table`` in which the rows lie whose partition columns are in ``parts``, a few rows."""
    rows = table.select(*parts.columns, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder"))
    wanted = parts.select(*[F.col(c).alias(f"_{c}") for c in parts.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in parts.columns]
    return [r["_folder"] for r in rows.join(F.broadcast(wanted), same, "left_semi").select("_folder").distinct().collect()]


def empty_folder(spark: SparkSession, folder: str, schema: StructType) -> None:
    """Leaves a folder of a partitioned table without rows; overwriting the folders that a frame has rows in can't do that."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)


def write_sorted(df: DataFrame, path: str, cluster_by: list[str]) -> None:
    """A table without folders whose files cover consecutive ranges of ``cluster_by``.

    The other columns continue the order, so a value on many rows may span several files.
    """
    order = [*cluster_by, *[c for c in df.columns if c not in cluster_by]]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def stored(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a result that several branches of a plan need: they scan a small columnar table
    of known size, and nothing upstream is computed again when an executor is lost.
    """
    path = shared_dir(df.sparkSession, "stored", f"{name}-{uuid.uuid4().hex[:12]}")
    write_stage(df, path, group_rows)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
