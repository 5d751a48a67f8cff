"""Landing folders to bronze tables, in micro-batches.

Each batch writes folders of its own, ``batch=<id>``, in overwrite mode: a batch that is
run again after a failure replaces what it left behind. A batch of sales also writes a manifest, with the folder, rows, first and
last load of each batch whose loads reach into the hours that audits look at; it is made of the one before and of what the
batch's own write has counted. The audit opens the folders named there, and nothing is listed.

With the default trigger a run takes in whatever has landed since the last one and
stops; if nothing has, no batch runs. ``processingTime="5 minutes"`` keeps polling.
Further keywords (``fmt``, ``max_files``, ``plain``, reader options) go to ``stream_feed``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline import schemas
from shelfline.operators.lookups import if_small
from shelfline.plans.bronze import (
    accepted_orders,
    cleanse_inventory,
    cleanse_pos,
    pos_quality_audit,
    rejected_orders,
)
from shelfline.plans.staging import Layouts, type_orders
from shelfline.sources.raw import stamp, stream_feed

# A reference table that may change while a stream polls is given as its path, or as a function that reads it;
# a frame is for tables that do not, since its list of files is that of its making.
Reference = DataFrame | str | Callable[[SparkSession], DataFrame]

# What the lookups read of the stores and the rates.
STORE_KEYS = ["retailer_code", "store_id", "store_key"]
RATE_COLUMNS = ["rate_date", "currency_code", "rate_to_usd"]
MANIFEST = "folder string, rows long, first_load timestamp_ntz, last_load timestamp_ntz"


def _write_batch(df: DataFrame, root: str, table: str, batch: int) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
        f"{root}/{table}/batch={batch}"
    )
    return seen.get["rows"]


def _now(table: Reference, session: SparkSession, *columns: str) -> DataFrame:
    """``columns`` of a reference table as it is at this batch: a path or a function is read anew."""
    if isinstance(table, str):
        table = session.read.parquet(table)
    elif not isinstance(table, DataFrame):
        table = table(session)
    return if_small(table.select(*columns))


def _spread(batch: DataFrame, max_files: int = 1000, **_) -> DataFrame:
    """A batch that may hold fewer files than there are cores, its rows dealt to all of them: one task reads a file of one row group.

    Rows are dealt by their place in the files, so that equal rows don't meet and a task that is run again deals alike.
    """
    cores = batch.sparkSession.sparkContext.defaultParallelism
    if max_files >= cores:
        return batch
    return batch.withColumn("_row", F.monotonically_increasing_id()).repartition(cores, "_row").drop("_row")


def _log(spark: SparkSession, root: str, job: str, batch: int, message: str) -> None:
    line = spark.range(1).select(F.lit(job).alias("job"), F.lit(message).alias("message"))
    line.coalesce(1).write.mode("overwrite").parquet(f"{root}/ingest_log/{job}/batch={batch}")


def read_batches(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A bronze table as one frame, without its folder column."""
    return spark.read.parquet(f"{root}/{table}").drop("batch")


def read_manifest(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """The manifest that a batch left: a row per batch of sales that audits may still ask for."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/pos_manifest/batch={batch}")


def _write_manifest(spark: SparkSession, root: str, batch: int, entry: tuple, since: datetime) -> list[str]:
    """Writes the manifest of a batch and returns the folders with loads at ``since`` or later.

    Audits look at ever later hours, so what one no longer needs is not needed again.
    """
    own = spark.createDataFrame([entry], MANIFEST)
    known = own if batch == 0 else read_manifest(spark, root, batch - 1).unionByName(own)
    recent = known.where(F.col("last_load") >= F.lit(since).cast("timestamp_ntz")).coalesce(1)
    recent.write.mode("overwrite").parquet(f"{root}/pos_manifest/batch={batch}")
    return [row["folder"] for row in read_manifest(spark, root, batch).select("folder").collect()]


def _start(
    stream: DataFrame, work: Callable[[DataFrame, int], None], root: str, job: str, processingTime: str | None
) -> StreamingQuery:
    trigger = {"processingTime": processingTime} if processingTime else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", f"{root}/_offsets/{job}")
        .trigger(**trigger)
        .start()
    )


def ingest_orders(
    spark: SparkSession,
    landing: str,
    root: str,
    run_time: datetime | str | None = None,
    processingTime: str | None = None,
    **source,
) -> StreamingQuery:
    """Each batch feeds two tables, ``orders_staged`` and ``orders_rejected``.

    The batch is parsed once and kept for both writes; lost blocks are read again.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        typed = type_orders(_spread(batch, **source)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            staged = _write_batch(accepted_orders(typed, run_time), root, "orders_staged", batch_id)
            rejected = _write_batch(rejected_orders(typed, run_time), root, "orders_rejected", batch_id)
        finally:
            typed.unpersist()
        _log(batch.sparkSession, root, "orders", batch_id, f"Staged: {staged} rows. Rejected: {rejected} rows.")

    return _start(stream_feed(spark, "raw_orders", landing, **source), work, root, "orders", processingTime)


def ingest_pos(
    spark: SparkSession,
    landing: str,
    root: str,
    stores: Reference,
    fx: Reference,
    as_of: datetime | str | None = None,
    processingTime: str | None = None,
    after: Callable[[DataFrame], None] | None = None,
    layouts: Layouts = Layouts(),
    **source,
) -> StreamingQuery:
    """Fills ``pos_cleansed``, then audits the last hour of loads into ``pos_quality_log``. The batch is read once.

    ``after`` is called with the cleansed rows of the batch, for refreshes that follow.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = f"pos_cleansed/batch={batch_id}"
        seen = Observation()
        rows = cleanse_pos(_spread(batch, **source), _now(stores, session, *STORE_KEYS), _now(fx, session, *RATE_COLUMNS), layouts)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.min("_loaded_at").alias("first"), F.max("_loaded_at").alias("last"))
        rows.write.mode("overwrite").parquet(f"{root}/{folder}")
        found = seen.get
        since = session.range(1).select((stamp(as_of) - F.expr("interval 1 hour")).alias("since")).first()["since"]
        recent = _write_manifest(session, root, batch_id, (folder, found["rows"], found["first"], found["last"]), since)
        cleansed = session.read.schema(schemas.POS_CLEANSED)
        loaded = cleansed.parquet(*[f"{root}/{f}" for f in recent]) if recent else session.createDataFrame([], schemas.POS_CLEANSED)
        _write_batch(pos_quality_audit(loaded, as_of, hours=1), root, "pos_quality_log", batch_id)
        _log(session, root, "pos", batch_id, f"Processed {found['rows']} POS records.")
        if after:
            after(cleansed.parquet(f"{root}/{folder}"))

    return _start(stream_feed(spark, "raw_pos", landing, **source), work, root, "pos", processingTime)


def ingest_inventory(
    spark: SparkSession,
    landing: str,
    root: str,
    stores: Reference,
    processingTime: str | None = None,
    layouts: Layouts = Layouts(),
    **source,
) -> StreamingQuery:
    """Fills ``inventory_cleansed``."""

    def work(batch: DataFrame, batch_id: int) -> None:
        rows = _write_batch(cleanse_inventory(_spread(batch, **source), _now(stores, batch.sparkSession, *STORE_KEYS), layouts), root, "inventory_cleansed", batch_id)
        _log(batch.sparkSession, root, "inventory", batch_id, f"Processed {rows} inventory records.")

    return _start(
        stream_feed(spark, "raw_inventory", landing, **source), work, root, "inventory", processingTime
    )
