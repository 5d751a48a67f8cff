"""Incremental upkeep of partitioned parquet tables."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.session import shared_dir
from shelfline.sources.raw import stamp
from shelfline.sources.tables import empty_folder, read_table, table_exists, write_clustered, write_stage


def newer_than(source: DataFrame, target: DataFrame | None, source_time: str, target_time: str, lookback: str | None = None) -> DataFrame:
    """Source rows loaded after the newest row of ``target``; all rows if it has none.

    ``lookback`` (such as ``'2 hours'``) moves the mark back to pick up stragglers. The target is scanned for one
    value; tables kept by ``upsert`` have it stored, see ``stored_mark``.
    """
    if target is None:
        return source
    return after_mark(source, source_time, target.agg(F.max(target_time).cast("string")).first()[0], lookback)


def after_mark(source: DataFrame, source_time: str, mark: str | None, lookback: str | None = None) -> DataFrame:
    """Source rows later than ``mark``; all if there is none. As a literal it prunes partitions and parquet row groups."""
    if mark is None:
        return source
    newest = stamp(mark)
    return source.where(F.col(source_time) > (newest - F.expr(f"interval {lookback}") if lookback else newest))


def latest_per_key(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row per key: the latest by ``order_by``, then the greatest by all columns in turn.

    A maximum is combined before the shuffle, so a key on a third of the rows arrives
    as one row per task; a ranking window would gather and sort all of them in one.
    """
    return _latest_of_groups(df, [key], order_by)


def spread_evenly(df: DataFrame, column: str, buckets: int = 4096, limit: int = 32, few: int = 1_000_000) -> bool:
    """Whether tasks that are dealt rows by ``column`` get about equal work: no bucket of its values holds over 1/``limit`` of the rows.

    A scan of that one column, counted before its shuffle. ``few`` rows are no burden, however they lie.
    """
    counted = df.groupBy(F.pmod(F.xxhash64(column), F.lit(buckets)).alias("_bucket")).agg(F.count(F.lit(1)).alias("rows"))
    most, rows = counted.agg(F.max("rows"), F.sum("rows")).first()
    return rows is None or rows <= few or most * limit <= rows


def _shared_hashes(rows: DataFrame, key: str) -> DataFrame:
    """Hashes that several rows' keys have; rows without a key are left out."""
    return rows.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")


def _latest_of_groups(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (*keys, order_by)]
    best = F.max(F.struct(order_by, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def _in_partitions(increment: DataFrame, partition_by: str | Sequence[str]) -> Column:
    """Filter on the partitions ``increment`` has rows in.

    The values are few, one for each folder that is about to be written, and as literals
    they prune the folders that are read; a join would read them all.
    """
    first, *rest = _columns(partition_by)
    rows = increment.select(first, *rest).distinct().collect()
    if not rest:
        return _is_one_of(first, [row[0] for row in rows])
    # Folders that differ in the first value only are named together.
    inner: dict[tuple, list] = {}
    for row in rows:
        inner.setdefault(tuple(row[1:]), []).append(row[0])
    groups = [reduce(and_, [_is_one_of(first, values), *[_is_one_of(c, [v]) for c, v in zip(rest, own, strict=True)]]) for own, values in inner.items()]
    return reduce(or_, groups, F.lit(False))


def _columns(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _is_one_of(name: str, values: list) -> Column:
    column, known = F.col(name), [v for v in values if v is not None]
    named = column.isin(known)
    return named if len(known) == len(values) else named | column.isNull()


@dataclass(frozen=True)
class UpsertResult:
    """What a run did. Its frames hold their rows until the next run on the same table."""

    written: int
    null_keys: int
    mode: str
    increment: DataFrame
    rejects: DataFrame  # rows without a key, all of them
    replaced: DataFrame  # what the table held under the keys of the increment; empty after a full load


def stage_of(spark: SparkSession, path: str) -> str:
    return shared_dir(spark, "upsert", hashlib.md5(path.encode()).hexdigest())


def note(spark: SparkSession, stage: str, state: str, mark: str | None) -> None:
    row = spark.range(1).select(F.lit(state).alias("state"), F.lit(mark).cast("string").alias("mark"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{stage}/state")


def note_emptied(spark: SparkSession, stage: str, folders: list[str]) -> None:
    """Folders that a change set leaves without rows; as few as it touches at most."""
    spark.createDataFrame([(f,) for f in folders], "folder string").coalesce(1).write.mode("overwrite").parquet(f"{stage}/emptied")


def noted(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """State and mark of the last run on ``path``; done and none if there was no run, or its notes are gone."""
    stage = stage_of(spark, path)
    return tuple(spark.read.parquet(f"{stage}/state").first()) if table_exists(spark, f"{stage}/state") else ("done", None)


def stored_mark(spark: SparkSession, path: str) -> str | None:
    """The newest ``order_by`` value that the runs on ``path`` brought in, without a look at the table.

    It is written together with the state of a merge, so a merge that ``finish_interrupted`` completes has its mark too.
    """
    return noted(spark, path)[1]


def finish_interrupted(spark: SparkSession, path: str, partition_by: str | Sequence[str], cluster_by: list[str]) -> bool:
    """Completes a merge, a first load or a full refresh that died while it replaced ``path`` or partitions of it.

    Call it before a mark is taken from the table: a table half replaced already holds
    rows of the new load, and its newest load time would hide the rest of them.
    """
    stage = stage_of(spark, path)
    state, mark = noted(spark, path)
    if state == "done":
        return False
    gone = "_reject" if state == "full" else "_gone"
    rows = spark.read.parquet(f"{stage}/{'increment' if state == 'full' else 'merged'}")
    write_clustered(rows.where(~F.col(gone)).drop(gone), path, partition_by, cluster_by, only_touched=state != "full")
    if state == "changed":
        inside = rows.drop(gone, *_columns(partition_by)).schema
        for row in spark.read.parquet(f"{stage}/emptied").collect():
            empty_folder(spark, row["folder"], inside)
    note(spark, stage, "done", mark)
    return True


def upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    partition_by: str | Sequence[str],
    order_by: str = "_loaded_at",
    cluster_by: list[str] | None = None,
    mode: str = "merge",
    dealt_by: str | None = None,
) -> UpsertResult:
    """Replaces rows of ``path`` that share a key with ``source`` and adds the others.

    The partition columns must follow from the key, so a key never moves. Only the
    partitions that ``source`` touches are read and rewritten. Rows without a key are
    left out of the table and are in ``rejects``, every one. Increment and merged partitions are written to the shared
    folder before the table is changed, see ``finish_interrupted``. ``mode="full"``
    rebuilds the table from ``source``. A table has one writer at a time. Counts and the newest load are taken by the write of the increment.

    ``dealt_by`` names a column that rows of a key share and that ``source`` was dealt or joined by last, so that such rows lie together already.
    They are folded there, and whole rows are not shuffled by key once more; a count of hashed keys finds out whether a key was left on
    several rows, and if so all are folded by key. Hot values of that column would not be split, see ``spread_evenly``.
    """
    cluster_by = cluster_by or [key]
    stage = stage_of(spark, path)
    finish_interrupted(spark, path, partition_by, cluster_by)
    exists = mode != "full" and table_exists(spark, path)
    before = stored_mark(spark, path)
    if exists and before is None:
        before = read_table(spark, path).agg(F.max(order_by).cast("string")).first()[0]
    # A row without a key is a group of its own, so that nothing folds such rows or gathers them.
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())

    def staged(rows: DataFrame, *groups: str) -> dict:
        folded = _latest_of_groups(rows.withColumn("_alone", alone), [*groups, "_alone"], order_by).drop("_alone")
        seen = Observation()
        newest = F.max(F.when(~F.col("_reject"), F.col(order_by)))
        counted = folded.withColumn("_reject", F.col(key).isNull()).observe(
            seen, F.count_if(~F.col("_reject")).alias("written"), F.count_if("_reject").alias("null_keys"),
            newest.cast("string").alias("newest"),
            F.greatest(newest, F.lit(before).cast(source.schema[order_by].dataType)).cast("string").alias("newest_of_all"),
        )
        write_stage(counted, f"{stage}/increment")
        return seen.get

    found = staged(source, key, *([dealt_by] if dealt_by else []))
    if dealt_by and not _shared_hashes(spark.read.parquet(f"{stage}/increment"), key).isEmpty():
        write_stage(spark.read.parquet(f"{stage}/increment").drop("_reject"), f"{stage}/folded")
        found = staged(spark.read.parquet(f"{stage}/folded"), key)
    written, null_keys = found["written"], found["null_keys"]
    split = spark.read.parquet(f"{stage}/increment")
    increment, rejects = (split.where(F.col("_reject") == r).drop("_reject") for r in (False, True))

    if not exists:
        note(spark, stage, "full", found["newest"])
        finish_interrupted(spark, path, partition_by, cluster_by)
        return UpsertResult(written, null_keys, "full", increment, rejects, increment.limit(0))
    if written == 0:
        return UpsertResult(0, null_keys, "merge", increment, rejects, increment.limit(0))

    existing = read_table(spark, path, increment.schema).where(_in_partitions(increment, partition_by))
    met = increment.select(key, F.lit(True).alias("_met"))
    old = existing.join(met, key, "left").select(*increment.columns, F.coalesce("_met", F.lit(False)).alias("_gone"))
    write_stage(old.unionByName(increment.withColumn("_gone", F.lit(False))), f"{stage}/merged")
    note(spark, stage, "merged", found["newest_of_all"])
    finish_interrupted(spark, path, partition_by, cluster_by)
    replaced = spark.read.parquet(f"{stage}/merged").where("_gone").drop("_gone")
    return UpsertResult(written, null_keys, "merge", increment, rejects, replaced)
