"""Landing feeds: every payload column is text, plus where and when it was loaded."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.schemas import LINEAGE, RAW_INVENTORY, RAW_ORDERS, RAW_POS, RAW_PROMO

FEED_SCHEMAS: dict[str, StructType] = {
    "raw_orders": RAW_ORDERS,
    "raw_pos": RAW_POS,
    "raw_inventory": RAW_INVENTORY,
    "raw_promo": RAW_PROMO,
}


def stamp(value: datetime | str | None) -> Column:
    """A timestamp without zone: the given one, or now."""
    if value is None:
        return F.localtimestamp()
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value) -> Column:
    """A date: the given one, or today."""
    return F.current_date() if value is None else F.lit(str(value)).cast("date")


def read_feed(
    spark: SparkSession, feed: str, path: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A feed whose files already hold the two lineage columns."""
    return spark.read.format(fmt).options(**options).schema(FEED_SCHEMAS[feed]).load(path)


def read_files(
    spark: SparkSession,
    feed: str,
    path: str,
    fmt: str = "csv",
    loaded_at: datetime | str | None = None,
    **options: str,
) -> DataFrame:
    """A feed of plain payload files; lineage is taken from the scan."""
    return with_lineage(spark.read.format(fmt).options(**options).schema(_payload(feed)).load(path), loaded_at)


def _payload(feed: str) -> StructType:
    return StructType([f for f in FEED_SCHEMAS[feed].fields if f.name not in LINEAGE])


def with_lineage(scan: DataFrame, loaded_at: datetime | str | None = None) -> DataFrame:
    """Adds file path and load time to a frame that comes straight from files."""
    return scan.select(
        "*", F.col("_metadata.file_path").alias("_file_name"), stamp(loaded_at).alias("_loaded_at")
    )


def stream_feed(
    spark: SparkSession,
    feed: str,
    path: str,
    fmt: str = "parquet",
    max_files: int = 1000,
    plain: bool = False,
    **options: str,
) -> DataFrame:
    """Append-only change stream of a landing folder. Files already there are read first.

    ``plain`` files hold the payload only; their lineage is taken from the scan and the
    time of the batch, which a replayed batch keeps.
    """
    reader = spark.readStream.format(fmt).options(**options).option("maxFilesPerTrigger", max_files)
    if plain:
        return with_lineage(reader.schema(_payload(feed)).load(path))
    return reader.schema(FEED_SCHEMAS[feed]).load(path)


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Makes frames readable by name: ``spark.table(name)`` or SQL text."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
