"""Reversible line deduplication: cuckoo filters in front of exact reference counts.

The index has three tables in the shared folder, written anew or added to by each change:

* references: a log of (digest of a line's key, doc_id, +1 or -1), one entry when a document
  comes to hold the key and one when it goes;
* counts: per digest the number of documents that hold it and the largest of their ids;
* filters: per shard of the digests a cuckoo filter of those held by ``min_docs`` documents or more.

Inserting or deleting documents appends to the log, recounts the keys touched, and adds to or
takes from the filters the keys that crossed the limit; deleting what was inserted restores the counts and the filters'
members. Deduplication asks the filters first, which are small; only the lines they let through (the
frequent ones and a few false hits) are joined with the exact counts, which decide.

Counts are combined before each shuffle, so a line of a third of all documents is a few rows in it.
Filters hold 16 bits a key. They are broadcast up to ``FILTER_BYTES``; past that the lines are joined with the exact counts
without asking them, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import batches, others, rows_of, shielded, stored, table

MIN_DOCS = 3
MIN_CHARACTERS = 20
SHARD_KEYS = 1 << 14
FILTER_BYTES = 32 << 20
BLANKS = " \t\n\x0b\x0c\r"

_REFERENCES = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64())])


def line_key(line: str) -> bytes | None:
    """Digest of the stripped, lower-cased line; None if it is too short to count."""
    line = line.strip(BLANKS)
    if len(line) < MIN_CHARACTERS:
        return None
    return hashlib.blake2b(line.encode("utf-8", "replace").lower(), digest_size=16).digest()


def references(docs: DataFrame) -> DataFrame:
    """(digest, doc_id) once for each key and row of ``docs``."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in parts:
                for doc_id, text in rows_of(batch):
                    keys = {line_key(line) for line in (text or "").split("\n")}
                    keys.discard(None)
                    for key in keys:
                        yield key, doc_id

        yield from batches(found(), _REFERENCES, size=1 << 15)

    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "digest binary, doc_id long")


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may be in either of two buckets.

    The second bucket is the first one xor a number that comes from the fingerprint, so a fingerprint can be moved
    or deleted without its key. Only keys that were inserted may be deleted.
    """

    SLOTS, KICKS = 4, 500

    def __init__(self, keys: int, state: bytes | None = None):
        self.buckets = 1 << max(1, int(np.ceil(np.log2(max(keys, 1) / (self.SLOTS * 0.85)))))
        self.table = np.zeros((self.buckets, self.SLOTS), np.uint16)
        if state is not None:
            self.table = np.frombuffer(state, np.uint16).reshape(-1, self.SLOTS).copy()
            self.buckets = len(self.table)

    def _places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of digests given as rows of two 64-bit numbers."""
        prints = (digests[:, 1] >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (digests[:, 1] & np.uint64(self.buckets - 1)).astype(np.int64)
        return prints, first, first ^ self._step(prints)

    def _step(self, prints):
        return (np.asarray(prints).astype(np.int64) * 0x5BD1E995 >> 7) & (self.buckets - 1)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(digests)
        wanted = prints[:, None]
        return (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)

    def insert(self, digests: np.ndarray) -> bool:
        """False if there is no room; the filter is then to be built anew, larger."""
        for number, (own, first, second) in enumerate(zip(*self._places(digests), strict=True)):
            at, mark = int(first), int(own)
            if not (self._put(at, mark) or self._put(int(second), mark)):
                for kick in range(self.KICKS):
                    slot = (number + kick) % self.SLOTS
                    mark, self.table[at, slot] = int(self.table[at, slot]), mark
                    at ^= int(self._step(mark))
                    if self._put(at, mark):
                        break
                else:
                    return False
        return True

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = mark
        return len(free) > 0

    def delete(self, digests: np.ndarray) -> None:
        for own, first, second in zip(*self._places(digests), strict=True):
            for bucket in (int(first), int(second)):
                at = np.flatnonzero(self.table[bucket] == own)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


def _numbers(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def _shard(digest, shards: int):
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


def _build_filters(frequent: DataFrame, shards: int) -> DataFrame:
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        digests, size = _numbers(sorted(rows["digest"])), len(rows)
        while not (own := CuckooFilter(size)).insert(digests):
            size *= 2
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "state": [own.table.tobytes()]})

    return frequent.select("digest", _shard("digest", shards).alias("shard")).groupBy("shard").applyInPandas(build, "shard int, state binary")


@dataclass(frozen=True)
class LineIndex:
    """Which documents hold which lines."""

    log: DataFrame  # digest, doc_id, change
    counts: DataFrame  # digest, n_docs, holder
    filters: DataFrame  # shard, state
    shards: int
    min_docs: int = MIN_DOCS

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> LineIndex:
        # A doc_id on several rows holds a key once, so one deletion takes it back.
        log = stored(references(docs).distinct().withColumn("change", F.lit(1)), "line-references")
        counts = stored(_tally(log), "line-counts")
        frequent = counts.where(F.col("n_docs") >= min_docs)
        shards = 1 + frequent.count() // shard_keys
        return cls(log, counts, stored(_build_filters(frequent, shards), "line-filters"), shards, min_docs)

    def insert(self, docs: DataFrame) -> LineIndex:
        """With the lines of ``docs`` too. A document already held only gains the lines it did not have."""
        held = self._live().select("digest", "doc_id")
        new = references(docs).distinct().join(held, ["digest", "doc_id"], "left_anti")
        return self._changed(new.withColumn("change", F.lit(1)))

    def delete(self, ids: DataFrame) -> LineIndex:
        """Without the documents whose doc_id is in ``ids``; ids not held change nothing."""
        gone = self._live().join(ids.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi")
        return self._changed(gone.select("digest", "doc_id", F.lit(-1).alias("change")))

    def _live(self) -> DataFrame:
        return _live(self.log)

    def _changed(self, entries: DataFrame) -> LineIndex:
        entries = stored(entries, "line-changes")
        log = self.log.unionByName(entries)
        touched = entries.select("digest").distinct()
        fresh = _count(log.join(touched, "digest", "left_semi"))
        fresh = touched.join(fresh, "digest", "left").select("digest", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "holder")
        before = self.counts.join(touched, "digest", "left_semi").select("digest", F.col("n_docs").alias("n_before"))
        fresh = stored(fresh.join(before, "digest", "left"), "line-recounts")
        untouched = self.counts.join(touched, "digest", "left_anti")
        counts = stored(untouched.unionByName(fresh.where("n_docs > 0").select("digest", "n_docs", "holder")), "line-counts")

        was, now = F.coalesce("n_before", F.lit(0)) >= self.min_docs, F.col("n_docs") >= self.min_docs
        crossed = fresh.where(was != now).select("digest", now.alias("joins"), _shard("digest", self.shards).alias("shard"))
        filters = self._update_filters(crossed, counts)
        return replace(self, log=log, counts=counts, filters=filters)

    def _update_filters(self, crossed: DataFrame, counts: DataFrame) -> DataFrame:
        def update(key, state: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
            own = CuckooFilter(len(change), state["state"].iloc[0] if len(state) else None)
            joins = change["joins"].to_numpy(bool)
            if (~joins).any():
                own.delete(_numbers(sorted(change["digest"][~joins])))
            fits = not joins.any() or own.insert(_numbers(sorted(change["digest"][joins])))
            return pd.DataFrame({"shard": [key[0]], "state": [own.table.tobytes() if fits else None]})

        both = self.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(update, "shard int, state binary")
        both = stored(both, "line-filters")
        # Shards without room for what came are built anew from the exact counts.
        full = both.where("state is null").select("shard")
        keys = counts.where(F.col("n_docs") >= self.min_docs).select("digest", _shard("digest", self.shards).alias("shard"))
        rebuilt = _build_filters(keys.join(full, "shard", "left_semi"), self.shards)
        return stored(both.where("state is not null").unionByName(rebuilt), "line-filters")

    def let_through(self, lines: DataFrame) -> DataFrame:
        """The (digest, doc_id) rows that the filters can't rule out."""
        size = self.filters.agg(F.sum(F.length("state"))).first()[0] or 0
        if size > FILTER_BYTES:
            return lines
        filters = {r["shard"]: CuckooFilter(0, bytes(r["state"])) for r in self.filters.toLocalIterator()}
        shared = lines.sparkSession.sparkContext.broadcast(filters)

        def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in parts:
                shard, keep = np.array(batch.column(2)), np.zeros(batch.num_rows, bool)
                digests = _numbers(batch.column(0).to_pylist())
                order = np.argsort(shard, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    if len(own) and (found := shared.value.get(int(shard[own[0]]))):
                        keep[own] = found.contains(digests[own])
                yield batch.filter(pa.array(keep)).select([0, 1])

        return lines.select("digest", "doc_id", _shard("digest", self.shards).alias("shard")).mapInArrow(work, "digest binary, doc_id long")


def _live(log: DataFrame) -> DataFrame:
    return log.groupBy("digest", "doc_id").agg(F.sum("change").alias("change")).where("change > 0")


def _tally(held: DataFrame) -> DataFrame:
    """From distinct (digest, doc_id)."""
    return held.groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("holder"))


def _count(log: DataFrame) -> DataFrame:
    return _tally(_live(log))


def dedup_lines(docs: DataFrame, index: LineIndex, lines: DataFrame | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` with frequent lines taken out of ``text``, and n_lines and n_dropped.

    A key of at least 20 code points held by ``min_docs`` documents of the index stays in the largest doc_id that holds
    it and goes from all others, with all its lines. A null or empty text is one empty line and becomes an empty
    text. Rows with one doc_id are one document; a null doc_id is none: its lines count
    nowhere and all stay. Columns named n_lines and n_dropped are replaced. ``lines`` are the references of ``docs``, if
    they are at hand.
    """
    kept = others(docs, "n_lines", "n_dropped", keep=keep)
    lines = references(docs) if lines is None else lines
    exact = index.counts.where(F.col("n_docs") >= index.min_docs)
    frequent = index.let_through(lines).join(exact, "digest").where(F.col("doc_id") != F.col("holder"))
    drops = frequent.groupBy(F.col("doc_id").alias("__doc_id")).agg(F.collect_set("digest").alias("__drops"))
    docs = docs.select(*kept, *[c for c in ("text",) if c not in kept], *[F.col("doc_id").alias("__id")])
    joined = docs.join(drops.hint("shuffle_hash"), F.col("__id") == F.col("__doc_id"), "left").drop("__id", "__doc_id")
    at_text = joined.columns.index("text")
    schema = T.StructType(joined.schema.fields[:-1]).add("n_lines", "long").add("n_dropped", "long")

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts, n_lines, n_dropped = [], [], []
                for text, drop in zip(part.column(at_text).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True):
                    split = (text or "").split("\n")
                    gone = set(drop or ())
                    stay = [x for x in split if line_key(x) not in gone] if gone else split
                    texts.append("\n".join(stay))
                    n_lines.append(len(split))
                    n_dropped.append(len(split) - len(stay))
                columns = [*part.columns[:at_text], pa.array(texts, pa.string()), *part.columns[at_text + 1 : -1], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(work, schema)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = LineIndex.build(docs)
    return dedup_lines(docs, index, lines=index.log.select("digest", "doc_id")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without the lines that many of them share."""

    def work(own: DataFrame) -> DataFrame:
        index = LineIndex.build(own)
        return dedup_lines(own, index, lines=index.log.select("digest", "doc_id"))

    return shielded(docs, work)


OP3_SQL = r"""
with lines as (
    select r, doc_id, unnest(string_split(t, chr(10))) as line, unnest(range(len(string_split(t, chr(10))))) as pos
    from (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents)
), keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), frequent as (
    select key, max(doc_id) as holder from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3
), marked as (
    select k.*, f.key is not null and k.doc_id is not null and k.doc_id <> f.holder as gone from keyed k left join frequent f using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by r, doc_id
"""
