"""Ranked lexical search over bit-sliced Bloom signatures.

Documents lie in blocks, those of a block much alike in their number of distinct terms. A block's index are bit slices: row r has one
bit a document, and a term sets the bits of its document in ``HASHES`` rows. So the documents that may hold a term are the
conjunction of a few rows, for all documents of the block at once; it may name too many, never too few. A term that occurs
2, 4 or 8 times or more is entered again, as a term of that level, so the slices bound its frequency too.

A query adds up its terms' slices by weight: the sum over the levels, times what the level adds to a score at the document's length, is
an upper bound of the document's score. Documents are scored exactly, from the block's term lists, best bounds first; a document whose
bound lies below the k-th score found by then can't be among the k best. All others are scored. That score is carried from block
to block of a task, so later blocks score few.

Queries are searched in groups of about ``QUERY_TERMS`` terms, and a group is what is broadcast. Numbers of documents per term, exact, are a
table of the index; no weight is taken from the signatures.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import batches, rows_of, stored, table
from shelfline.operators.lookups import join_folded

HASHES = 4
DENSITY = 0.3  # share of bits that may be set in the widest document's signature
LEVELS = (1, 2, 4, 8)  # frequencies from which a term has entries of its own
AREA = 1 << 19  # documents of a block times entries of the widest
HELD_ENTRIES = 1 << 20
QUERY_TERMS = 50_000
SALTS = 32
ROW_GROUP = 4  # blocks, of several megabytes each, that a reader or writer holds at once

BLOCKS = "block long, n_docs long, n_terms long, n_words long, n_rows long, doc_ids binary, id_known binary, lengths binary, slices binary, dictionary string, ends binary, terms binary, times binary"
_TYPES = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "int": pa.int32()}
# Bytes that part terms; A-Z are lower-cased, all else stays.
_PARTING = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TRANSLATION = bytes(0x20 if b in _PARTING else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TRANSLATION).split()


def hashed_rows(term: bytes, level: int) -> tuple[int, int]:
    """Two hashes of an entry; its rows are first + i * second, modulo the number of rows."""
    h = xxhash.xxh3_128_intdigest(term, seed=level)
    return h & 0x7FFFFFFF, h >> 64 & 0x7FFFFFFF | 1


def _rows(first: np.ndarray, second: np.ndarray, n_rows: int) -> np.ndarray:
    return (first[:, None] + np.arange(HASHES) * second[:, None]) % n_rows


def build_index(docs: DataFrame, area: int = AREA, held_entries: int = HELD_ENTRIES) -> DataFrame:
    """The stored index of ``docs``: a row a block, every row of ``docs`` in one of them."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(_blocks(parts, area, held_entries), _schema(BLOCKS), size=2)

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, BLOCKS), "lexical-index", group_rows=ROW_GROUP)


def _blocks(parts: Iterator[pa.RecordBatch], area: int, held_entries: int) -> Iterator[tuple]:
    task, number = TaskContext.get().partitionId() << 32, 0
    codes: dict[bytes, int] = {}
    held: list[tuple[int | None, np.ndarray, np.ndarray]] = []
    entries = 0

    def cut() -> Iterator[tuple]:
        """Blocks of the documents held, those with few terms first."""
        nonlocal number
        known = list(codes)
        sizes = [_entries(times) for _, _, times in held]
        order = sorted(range(len(held)), key=sizes.__getitem__)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * sizes[order[end]] <= area:
                end += 1
            yield task + number, *_block([held[i] for i in order[at:end]], known, sizes[order[end - 1]])
            number, at = number + 1, end

    for batch in parts:
        for doc_id, text in rows_of(batch):
            found = terms_of(text)
            for term in set(found).difference(codes):
                codes[term] = len(codes)
            own, times = np.unique(np.fromiter(map(codes.__getitem__, found), np.int64, len(found)), return_counts=True)
            held.append((doc_id, own, times))
            entries += len(own) + 16
            if entries >= held_entries:
                yield from cut()
                codes, held, entries = {}, [], 0
    yield from cut()


def _entries(times: np.ndarray) -> int:
    return int(sum((times >= level).sum() for level in LEVELS))


def _block(docs: list[tuple], known: list[bytes], widest: int) -> tuple:
    n_rows = max(64, math.ceil(widest * HASHES / -math.log(1 - DENSITY)))
    sizes = np.array([len(own) for _, own, _ in docs], np.int64)
    doc = np.repeat(np.arange(len(docs)), sizes)
    used, terms = np.unique(np.concatenate([own for _, own, _ in docs]), return_inverse=True)
    times = np.concatenate([t for _, _, t in docs])
    dictionary = [known[i] for i in used.tolist()]
    bits = np.zeros((n_rows, -(-len(docs) // 8) * 8), np.uint8)
    for level in LEVELS:
        has = times >= level
        if has.any():
            some, back = np.unique(terms[has], return_inverse=True)
            first, second = np.array([hashed_rows(dictionary[i], level) for i in some.tolist()], np.int64).T
            rows = _rows(first, second, n_rows)[back]
            bits[rows, doc[has][:, None]] = 1
    ids = [doc_id for doc_id, _, _ in docs]
    lengths = np.bincount(doc, times, len(docs)).astype(np.int64)
    return (
        len(docs), int((lengths > 0).sum()), int(lengths.sum()), n_rows, np.array([i or 0 for i in ids], np.int64).tobytes(), np.array([i is not None for i in ids], np.uint8).tobytes(),
        lengths.tobytes(), np.packbits(bits, axis=1).tobytes(), b"\n".join(dictionary).decode(), np.cumsum(sizes).tobytes(), terms.astype(np.uint32).tobytes(), times.astype(np.uint32).tobytes(),
    )


def document_counts(index: DataFrame) -> DataFrame:
    """term, df: in how many documents each term of the index occurs."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for dictionary, terms in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if terms:
                    found = np.bincount(np.frombuffer(terms, np.uint32))
                    yield pa.RecordBatch.from_arrays([pa.array(dictionary.split("\n"), pa.string()), pa.array(found, pa.int64())], names=["term", "df"])

    return index.select("dictionary", "terms").mapInArrow(work, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Queries:
    """A group of items in arrays: the terms of all of them with their rows' hashes, and each item's terms and weights."""

    def __init__(self, rows: list[tuple[int, str, int]], n_docs: int, n_words: int):
        self.n_docs, self.n_words = n_docs, max(1, n_words)
        self.terms = sorted({term for _, term, _ in rows})
        number = {term: i for i, term in enumerate(self.terms)}
        by_item: dict[int, list[tuple[int, int]]] = {}
        for item, term, weight in rows:
            by_item.setdefault(item, []).append((number[term], weight))
        self.items = sorted(by_item)
        self.own = [np.array(sorted(by_item[i]), np.int64).T for i in self.items]
        self.hashes = [np.array([hashed_rows(t.encode(), level) for t in self.terms], np.int64).T for level in LEVELS]


class Block:
    """One block of the index, opened for searches."""

    def __init__(self, row: dict, queries: Queries):
        self.ids = np.frombuffer(row["doc_ids"], np.int64)
        self.known = np.frombuffer(row["id_known"], np.uint8)
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.m = 75 + 25 * lengths * queries.n_docs // queries.n_words
        self.slices = np.frombuffer(row["slices"], np.uint8).reshape(row["n_rows"], -1)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.times = np.frombuffer(row["times"], np.uint32)
        dictionary = row["dictionary"].split("\n") if row["dictionary"] else []
        place = {term: i for i, term in enumerate(dictionary)}
        self.n_terms = max(1, len(dictionary))
        self.place = np.array([place.get(t, -1) for t in queries.terms], np.int64)
        docs = np.repeat(np.arange(len(self.ids)), np.diff(self.ends, prepend=0))
        self.keys = docs * self.n_terms + np.frombuffer(row["terms"], np.uint32)
        # What one weight adds to a score at most, for the frequencies of each level; a level counts what it adds to the one below.
        most = [*(level - 1 for level in LEVELS[1:]), int(self.times.max(initial=1))]
        worth = [self.worth(np.minimum(top, np.maximum(lengths, 1)), self.m) for top in most]
        self.steps = [worth[0], *(np.maximum(b - a, 0) for a, b in zip(worth, worth[1:], strict=False))]

    @staticmethod
    def worth(times: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * times // (1000 * times + 12 * m)

    def presence(self, queries: Queries, low: int, high: int) -> list[np.ndarray]:
        """Per level, which documents ``low`` to ``high`` may hold which terms that often; a row a term."""
        found, below = [], None
        for first, second in queries.hashes:
            rows = _rows(first, second, len(self.slices))
            has = np.bitwise_and.reduce(self.slices[rows, low // 8 : -(-high // 8)], axis=1)
            below = has if below is None else has & below
            found.append(np.unpackbits(below, axis=1)[:, : high - low])
        return found

    def bounds(self, queries: Queries, low: int, high: int) -> Iterator[np.ndarray]:
        """For each item upper bounds of the scores; sums of integers below 2^53, so exact."""
        presence = self.presence(queries, low, high)
        steps = [s[low:high].astype(np.float64) for s in self.steps]
        for own, weights in queries.own:
            total = np.zeros(high - low)
            for at in range(0, len(own), 2048):
                some, w = own[at : at + 2048], weights[at : at + 2048].astype(np.float64)
                for level, step in zip(presence, steps, strict=True):
                    total += step * (w @ level[some].astype(np.float64))
            yield total

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores."""
        here = self.place[terms] >= 0
        terms, weights = self.place[terms[here]], weights[here]
        if not len(terms) or not len(self.keys):
            return np.zeros(len(docs), np.int64)
        wanted = docs[:, None] * self.n_terms + terms[None, :]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        times = np.where(self.keys[at] == wanted, self.times[at].astype(np.int64), 0)
        return (weights[None, :] * self.worth(times, self.m[docs][:, None])).sum(1)


class Best:
    """The k best documents of one item so far: score, then smaller id, then an id before none."""

    def __init__(self, k: int):
        self.k = k
        self.scores = self.ids = np.zeros(0, np.int64)
        self.known = np.zeros(0, np.uint8)

    @property
    def least(self) -> int:
        """A score below this is not among the k best."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        enough = scores >= self.least
        scores, ids, known = (np.concatenate([old, new[enough]]) for old, new in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        order = np.lexsort((ids, known == 0, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]


def search_block(block: Block, queries: Queries, best: list[Best]) -> int:
    """Brings ``best`` up to date; returns how many documents were scored."""
    scored = 0
    # So many documents at once that their presence in all terms takes bounded memory.
    step = max(64, (1 << 21) // max(1, len(queries.terms)) // 8 * 8)
    for low in range(0, len(block.ids), step):
        high = min(low + step, len(block.ids))
        for found, (terms, weights), bounds in zip(best, queries.own, block.bounds(queries, low, high), strict=True):
            possible = np.flatnonzero(bounds >= found.least)
            possible = possible[np.argsort(-bounds[possible], kind="stable")]
            at, size = 0, 2 * found.k
            while at < len(possible) and bounds[possible[at]] >= found.least:
                docs = possible[at : at + min(size, 1 + (1 << 18) // len(terms))]
                found.add(block.scores(docs + low, terms, weights), block.ids[docs + low], block.known[docs + low])
                scored += len(docs)
                at, size = at + len(docs), size * 2
    return scored


def query_terms(asked: DataFrame) -> DataFrame:
    """item, term and times, from rows of item and text."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in parts:
                for item, text in rows_of(batch):
                    own, times = np.unique(np.array(terms_of(text), object), return_counts=True)
                    for term, n in zip(own.tolist(), times.tolist(), strict=True):
                        yield item, term.decode(), n

        yield from batches(found(), _schema("item long, term string, times long"))

    return asked.select("item", "text").mapInArrow(work, "item long, term string, times long")


def _weighted(terms: DataFrame, index: DataFrame, n_docs: int) -> DataFrame:
    """item, term and weight: what a term is worth, times its repeats. Terms of no document are left out."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            item, term, times, df = (batch.column(i) for i in range(4))
            worth = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.to_pylist()]
            yield pa.RecordBatch.from_arrays([item, term, pa.array(np.array(worth, np.int64) * times.to_numpy(), pa.int64())], names=["item", "term", "weight"])

    counted = join_folded(terms, document_counts(index), ["term"], "inner").select("item", "term", "times", "df")
    return counted.mapInArrow(work, "item long, term string, weight long").where("weight > 0")


def _found(index: DataFrame, queries: Queries, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best = [Best(k) for _ in queries.items]
        for batch in parts:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                search_block(Block(row, queries), queries, best)
        rows = (
            (item, score, doc_id if known else None)
            for item, own in zip(queries.items, best, strict=True)
            for score, doc_id, known in zip(own.scores.tolist(), own.ids.tolist(), own.known.tolist(), strict=True)
        )
        yield from batches(rows, _schema("item long, score long, doc_id long"))

    return index.drop("block", "n_docs", "n_terms", "n_words").mapInArrow(work, "item long, score long, doc_id long")


def search(index: DataFrame, items: DataFrame, k: int = 20, query_terms_at_once: int = QUERY_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest scores above 0 of each row of ``items`` (item_id, text); equal scores by
    ascending doc_id, documents without an id last.

    Every row of ``items`` is an item of its own, also if its id is null or stands on other rows; without terms, or with terms of no
    document only, it has no result. A document without terms (null, empty, or nothing but marks) counts in nothing and is
    never found. Repeated documents count and rank each. Texts are read whole. Other columns are not read.
    """
    spark = index.sparkSession
    n_docs, n_words = index.agg(F.sum("n_terms"), F.sum("n_words")).first()
    asked = stored(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "search-items")
    terms = stored(_weighted(query_terms(asked), index, n_docs or 0), "search-terms")
    groups = -(-terms.count() // query_terms_at_once)
    group = F.pmod(F.xxhash64("item"), F.lit(max(1, groups)))
    parts = []
    for i in range(groups):
        # About ``query_terms_at_once`` terms come to the driver and go out again.
        rows = [tuple(r) for r in terms.where(group == i).select("item", "term", "weight").collect()]
        if rows:
            parts.append(stored(_found(index, Queries(rows, n_docs, n_words), k), "search-found"))
    found = parts[0] if parts else spark.createDataFrame([], "item long, score long, doc_id long")
    for part in parts[1:]:
        found = found.unionByName(part)
    # Every task gives up to k rows an item: ranked in shares first, so that no task gets those of all.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("score", "doc_id"), F.lit(SALTS)))
    share = Window.partitionBy("item", "salt").orderBy(*order)
    least = salted.withColumn("place", F.row_number().over(share)).where(F.col("place") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order)).cast("int")
    best = least.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
with terms as (
    select row_number() over () as r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
), held as (
    select r, any_value(doc_id) as doc_id, term, count(*) as tf from terms group by r, term
), sizes as (
    select r, sum(tf)::bigint as n from held group by r
), totals as (
    select count(*) as n_docs, sum(n)::bigint as n_words from sizes
), weights as (
    select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from held, totals group by term
), items as (
    select row_number() over () as i, item_id, text from benchmark
), asked as (
    select i, term, count(*) as times from (
        select i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from items
    ) group by i, term
), scored as (
    select i, r, any_value(doc_id) as doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words))))::bigint as score
    from asked join held using (term) join weights using (term) join sizes using (r), totals
    group by i, r
), ranked as (
    select i, doc_id, score, row_number() over (partition by i order by score desc, doc_id nulls last)::integer as rank
    from scored where score > 0
)
select item_id, rank, doc_id, score from ranked join items using (i) where rank <= 20
"""
