"""Slowly changing dimension, type 2."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.upsert import latest_per_key
from shelfline.sources.raw import day

OPEN_END = "9999-12-31"


def apply_versions(
    dim: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: list[str],
    effective: str,
    order_by: str | None = None,
) -> DataFrame:
    """Dimension after ``updates`` take effect on day ``effective``.

    ``updates`` holds one row per key, or several of which the latest by ``order_by`` counts.

    A key whose tracked columns differ from its current version gets that version closed
    the day before and a new one opened; a new key gets its first version; the rest
    stays. A key and its update meet once, in one join; closing and opening are two
    elements of an array, not two more joins. Columns not tracked are taken from the
    update when a version is opened and never open one by themselves.

    A version that began on the day of the change is replaced: it was never in force before. A change
    that would take effect before the current version began fails the job. Updates without a key are left
    out; ``quality.missing(updates, key)`` lists them.
    """
    columns = dim.columns
    updates = updates.where(F.col(key).isNotNull())
    if order_by:
        updates = latest_per_key(updates, key, order_by)
    incoming = [c for c in updates.columns if c not in (key, "effective_from", "effective_to", "is_current")]
    start = day(effective)
    new = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in incoming])
    current = dim.where(F.col("is_current"))
    history = dim.where(~F.coalesce(F.col("is_current"), F.lit(False)))

    met = current.join(new, F.col(key) == F.col("_key"), "full")
    differs = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in tracked]
    )
    is_new = F.col(key).isNull() & F.col("_key").isNotNull()
    changed = F.col(key).isNotNull() & F.col("_key").isNotNull() & differs

    def row(**over: Column) -> Column:
        return F.struct(*[over.get(c, F.col(c)).cast(dim.schema[c].dataType).alias(c) for c in columns])

    opened = row(
        **{c: F.col(f"_new_{c}") for c in incoming if c in columns},
        **{key: F.col("_key"), "effective_from": start,
           "effective_to": F.lit(OPEN_END).cast("date"), "is_current": F.lit(True)},
    )
    too_late = F.concat(F.lit("a version begins after the change: "), F.col(key).cast("string"))
    last_day = F.when(F.col("effective_from") > start, F.raise_error(too_late).cast("date")).otherwise(F.date_sub(start, 1))
    closed = row(effective_to=last_day, is_current=F.lit(False))
    outcome = (
        F.when(changed & (F.col("effective_from") == start), F.array(opened))
        .when(changed, F.array(closed, opened)).when(is_new, F.array(opened)).otherwise(F.array(row()))
    )
    return history.unionByName(met.select(F.inline(outcome)).select(*columns))
