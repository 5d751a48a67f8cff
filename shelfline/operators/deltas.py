"""Changes of tables as rows gained and rows lost, and tables kept up to date with them.

A change set is what ``changes.snapshot_diff`` returns: INSERT and DELETE rows with ``copies``. A ``Delta`` is the same as two plain
frames, so that any job that works row by row, or key by key, can be run on either side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.changes import change_of, net_rows, snapshot_diff
from shelfline.operators.lookups import if_small, is_small
from shelfline.operators.upsert import _columns, _in_partitions, finish_interrupted, note, note_emptied, noted, stage_of
from shelfline.sources.tables import folders_of, read_table, stored, table_exists, write_stage

RUN = 10_000
FEW_DELETES = 16 * 1024 * 1024  # bytes of deletes that are broadcast, four times in a merge


@dataclass(frozen=True)
class Delta:
    """Rows that a table gained and rows that it lost; a row may be on both sides, which cancels out."""

    added: DataFrame
    removed: DataFrame

    @classmethod
    def between(cls, old: DataFrame, new: DataFrame, keys: list[str]) -> Delta:
        return cls.of(stored(snapshot_diff(old, new, keys).drop("is_update"), "table-changes"))

    @classmethod
    def of(cls, changes: DataFrame) -> Delta:
        """A change set, its copies spelled out."""
        rows = changes.drop("is_update")
        return cls(*(spelled_out(rows.where(F.col("change") == c).drop("change")) for c in ("INSERT", "DELETE")))

    def map(self, work: Callable[[DataFrame], DataFrame]) -> Delta:
        """The change of ``work(table)``, for work whose result for a row depends on that row alone."""
        return Delta(work(self.added), work(self.removed))

    def union(self, other: Delta) -> Delta:
        return Delta(self.added.unionByName(other.added), self.removed.unionByName(other.removed))

    def keys(self, *columns: str) -> DataFrame:
        """Distinct values of ``columns`` in rows that came or went."""
        return self.added.select(*columns).unionByName(self.removed.select(*columns)).distinct()

    def changes(self, keys: list[str]) -> DataFrame:
        """As a change set, without what cancels out."""
        return snapshot_diff(self.removed, self.added, keys)

    def net(self) -> DataFrame:
        """As a change set without ``is_update``, which only readers by key need; what cancels out is left out."""
        found = net_rows(self.removed, self.added)
        return found.select(change_of(), F.abs("copies").alias("copies"), *self.added.columns)

    def sums(self, keys: list[str], **measures: str) -> DataFrame:
        """By ``keys``, how much the sum of each of ``measures`` (SQL expressions) grew or shrank."""
        grown = self.added.select(*keys, *[F.expr(m).alias(n) for n, m in measures.items()])
        shrunk = self.removed.select(*keys, *[F.negative(F.expr(m)).alias(n) for n, m in measures.items()])
        return grown.unionByName(shrunk).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in measures])


def join_delta(
    left: DataFrame, d_left: Delta, old_right: DataFrame, new_right: DataFrame, d_right: Delta, keys: list[str], join: Callable[[DataFrame, DataFrame], DataFrame]
) -> Delta:
    """The change of ``join(left, right)`` after both sides changed; ``left`` as it was.

    ``join`` may be inner or left outer, with any condition besides equal ``keys``. Of ``left`` only rows whose keys changed on the right are
    joined again, once to each version of the right; what changed on the left meets the new right only:
    (L + dL) * R' - L * R = L|K * R' - L|K * R + dL * R'. An outer row that finds or loses its partner is among L|K.
    """
    met = left.join(if_small(stored(d_right.keys(*keys), "changed-keys")), keys, "left_semi").select(*left.columns)
    return Delta(join(met, new_right), join(met, old_right)).union(Delta(join(d_left.added, new_right), join(d_left.removed, new_right)))


class ChangesDontFit(ValueError):
    """A change set deletes rows that the table doesn't hold."""


def spelled_out(rows: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as ``copies`` says; many copies in runs that are spread over tasks in between."""
    columns = [c for c in rows.columns if c != copies]
    runs = rows.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({copies} - 1) div {RUN}"))))
    in_run = F.least(F.lit(RUN), F.col(copies) - F.col("_run") * RUN).cast("int")
    return runs.withColumn("_copy", F.explode(F.sequence(F.lit(1), in_run))).select(*columns)


def _same(left: str, right: str, columns: list[str]):
    return reduce(and_, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns])


def _deletes(changes: DataFrame, columns: list[str]) -> DataFrame:
    return changes.where("change = 'DELETE'").groupBy(*columns).agg(F.sum("copies").alias("copies"))


def _matched(target: DataFrame, deletes: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct rows of ``target`` that ``deletes`` names, with how many copies there are and how many go."""
    held = target.select(*columns).alias("t").join(if_small(deletes).alias("d"), _same("t", "d", columns), "left_semi")
    held = held.groupBy(*columns).agg(F.count(F.lit(1)).alias("held"))
    return held.alias("t").join(deletes.alias("d"), _same("t", "d", columns)).select(*[F.col(f"t.`{c}`") for c in columns], "held", "copies")


def _compared(target: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a change set deletes, and which of it ``target`` holds; both stored."""
    columns = target.columns
    deletes = stored(_deletes(changes, columns), "deletes")
    return deletes, stored(_matched(target, deletes, columns), "deleted")


def _applied(target: DataFrame, changes: DataFrame, deletes: DataFrame, matched: DataFrame) -> DataFrame:
    columns = target.columns
    kept = target.alias("t").join(if_small(deletes).alias("d"), _same("t", "d", columns), "left_anti")
    rest = matched.withColumn("copies", F.col("held") - F.col("copies")).where("copies > 0").drop("held")
    added = changes.where("change = 'INSERT'").select(*columns, "copies")
    return kept.unionByName(spelled_out(rest)).unionByName(spelled_out(added))


def _missing(deletes: DataFrame, matched: DataFrame) -> DataFrame:
    columns = [c for c in deletes.columns if c != "copies"]
    both = deletes.alias("d").join(matched.alias("t"), _same("d", "t", columns), "left")
    missing = F.col("d.copies") - F.coalesce("held", F.lit(0))
    return both.select(*[F.col(f"d.`{c}`") for c in columns], missing.alias("copies")).where("copies > 0")


def _counted(target: DataFrame, deletes: DataFrame) -> DataFrame:
    """Each distinct row of either frame, with ``_left``: how many copies stay, below zero if more go than there are. One shuffle, whatever goes."""
    columns = target.columns
    held = target.select(*columns, F.lit(1).cast("bigint").alias("_left"))
    rows = held.unionByName(deletes.select(*columns, (-F.col("copies")).alias("_left")))
    return rows.groupBy(*columns).agg(F.sum("_left").alias("_left"))


def _settled(target: DataFrame, changes: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """``target`` after a stored change set, and how many rows to delete it lacks; to be asked once the rows are written.

    Few deletes are broadcast, and all rows they don't name pass untouched. Many would cost several joins over all columns, so then
    they are counted together with the rows of ``target``.
    """
    if is_small(changes.where("change = 'DELETE'"), FEW_DELETES):
        compared = _compared(target, changes)
        missing = _missing(*compared).agg(F.sum("copies")).first()[0] or 0
        return _applied(target, changes, *compared), lambda: missing
    seen = Observation()
    lacking = F.sum(F.greatest(-F.col("_left"), F.lit(0))).alias("missing")
    found = _counted(target, changes.where("change = 'DELETE'")).observe(seen, lacking)
    rest = found.where("_left > 0").withColumnRenamed("_left", "copies")
    # What comes is added to what is left, so it needs no counting.
    added = changes.where("change = 'INSERT'").select(*target.columns, "copies")
    return spelled_out(rest).unionByName(spelled_out(added)), lambda: seen.get["missing"] or 0


def apply_changes(target: DataFrame, changes: DataFrame) -> DataFrame:
    """``target`` after a change set: as many copies of each row go and come as ``copies`` says.

    Both halves of an update are a DELETE and an INSERT, so ``is_update`` needs no care of its own. Rows that no DELETE names pass
    untouched; only those it names are counted, and all of them if it names many. What it names beyond the copies there are is ignored
    here, see ``missing_deletes``.
    """
    return _settled(target, stored(changes.drop("is_update"), "changes"))[0]


def missing_deletes(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows that a change set deletes and ``target`` doesn't hold, with how many copies are missing."""
    return _missing(*_compared(target, changes))


def merge_changes(
    spark: SparkSession, path: str, changes: DataFrame, partition_by: str | Sequence[str], cluster_by: list[str], version: str | None = None
) -> str:
    """Applies a change set to a stored table: ``created``, ``merged`` or ``skipped``.

    Only the partitions that the changes have rows in are read and rewritten. They are written to the shared folder before the
    table is touched; ``finish_interrupted`` completes a merge that died. Applying changes twice would be wrong, so give each
    set a ``version``: one that is the last applied already is skipped. A set that deletes rows the table doesn't hold fails with
    ``ChangesDontFit`` and changes nothing in the table. ``is_update`` is not needed.
    """
    finish_interrupted(spark, path, partition_by, cluster_by)
    if version is not None and noted(spark, path)[1] == version:
        return "skipped"
    stage = stage_of(spark, path)
    columns = [c for c in changes.columns if c not in ("change", "is_update", "copies")]
    changes = changes.drop("is_update")
    exists = table_exists(spark, path)
    if exists:
        changes = stored(changes, "changes")
        schema = changes.select(*columns).schema
        target = read_table(spark, path, schema).where(_in_partitions(changes, _columns(partition_by))).select(*columns)
        after, missing = _settled(target, changes)
    else:
        seen, gone = Observation(), F.when(F.col("change") == "DELETE", F.col("copies"))
        rows = changes.observe(seen, F.sum(gone).alias("missing")).where("change = 'INSERT'")
        after, missing = spelled_out(rows.select(*columns, "copies")), lambda: seen.get["missing"] or 0
    # What lies there is of no account before it is noted.
    flag, name = ("_gone", "merged") if exists else ("_reject", "increment")
    write_stage(after.withColumn(flag, F.lit(False)), f"{stage}/{name}")
    if missing():
        raise ChangesDontFit(f"{missing()} rows to delete are not in {path}")
    if not exists:
        note(spark, stage, "full", version)
    else:
        parts = _columns(partition_by)
        left = spark.read.parquet(f"{stage}/merged").select(*parts).distinct()
        touched = changes.select(*parts).distinct().alias("d").join(left.alias("t"), _same("d", "t", parts), "left_anti")
        note_emptied(spark, stage, folders_of(read_table(spark, path), touched))
        note(spark, stage, "changed", version)
    finish_interrupted(spark, path, partition_by, cluster_by)
    return "merged" if exists else "created"
