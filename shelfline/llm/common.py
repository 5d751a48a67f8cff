"""What the operators share: reading rows in tasks, stored tables, fixed character rules."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.sources.tables import stored

__all__ = ["ascii_lower", "batches", "by_key", "code_text", "held_out", "lowered", "others", "rows_of", "shielded", "stored", "table"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased. ``bytes.lower`` touches ASCII only; a lone surrogate,
    which Spark can't store but a caller may pass, becomes a question mark."""
    return (text or "").encode("utf-8", "replace").lower()


def held_out(doc_id: Column, buckets: int, bucket: int) -> Column:
    """crc32 of the id's text, modulo ``buckets``, is ``bucket``. A null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets) == bucket


def others(df: DataFrame, *own: str, keep: tuple[str, ...] | None = None) -> list[str]:
    """Columns of ``df`` (of ``keep`` only) without those that an operator adds; case doesn't tell names apart."""
    taken = {c.lower() for c in own}
    return [c for c in (keep or df.columns) if c.lower() not in taken]


def shielded(docs: DataFrame, work: Callable[[DataFrame], DataFrame], used: tuple[str, ...] = ("doc_id", "text", "lang")) -> DataFrame:
    """``work`` over ``docs``, returning exactly the columns of ``docs``. Columns that ``work`` does
    not use get names that clash with nothing meanwhile."""
    names = {c: c if c in used else f"__own_{i}" for i, c in enumerate(docs.columns)}
    result = work(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return result.select(*[F.col(n).alias(c) for c, n in names.items()])


def code_text(doc_id) -> bytes:
    return b"" if doc_id is None else str(doc_id).encode()


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch as tuples, a few hundred at a time, so that long texts aren't all
    held as Python strings at once."""
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, weight: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows and about ``weight`` bytes of binary values."""
    held: list[tuple] = []
    held_bytes = 0
    for row in rows:
        held.append(row)
        held_bytes += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= size or held_bytes >= weight:
            yield _batch(held, schema)
            held, held_bytes = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def by_key(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Consecutive rows with the same first value."""
    return groupby(rows, key=lambda row: row[0])
