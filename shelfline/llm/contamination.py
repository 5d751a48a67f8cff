"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Items of at least ``window`` words give one pattern per window of consecutive words; a shorter
item is one pattern. Patterns of one length make a searcher of their own, so that the
shortest pattern does not shorten the jumps of all others. A searcher has three tables:

* shift: for a block of two neighbouring words, how far the window may move on without
  passing the end of a pattern; blocks that stand in no pattern allow the longest jump;
* buckets: for a block that ends patterns (shift 0), those patterns, by their first word too;
* the patterns themselves, compared word by word with the text where a bucket names them.

Words of documents are replaced by their number in the benchmark's vocabulary (0: not in it).
Documents are never shuffled. A benchmark of more than ``shard_words`` words is cut into shards by its tasks and written
as a table of parts. Shards pass over the documents one after another and add to the words already hit. Only one
shard at a time is read by the driver, broadcast and held in a task: the result of a pass is written before the next
one begins, so a larger benchmark takes more passes, not more memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import ascii_lower, batches, others, rows_of, shielded, stored, table

WINDOW = 10
SHARD_WORDS = 500_000
SHARD_BYTES_A_WORD = 8  # a guess; it decides how many tasks cut the benchmark, not how large a shard may be

_PARTS = pa.schema([("shard", pa.int64()), ("item", pa.string()), ("words", pa.binary())])
PARTS = "shard long, item string, words binary"

# Every byte that is no ASCII letter or digit and no part of a longer character separates words.
_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of characters beyond ASCII."""
    return ascii_lower(text).translate(_SEPARATORS).split()


class Searcher:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], set[str]]):
        self.length = length
        self.block = min(2, length)
        self.longest = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                block = pattern[end - self.block : end]
                key = block if self.block == 2 else block[0]
                self.shift[key] = min(self.shift.get(key, self.longest), length - end)
            key = pattern[-self.block :] if self.block == 2 else pattern[-1]
            self.buckets.setdefault(key, {}).setdefault(pattern[0], []).append((pattern, items))

    def find(self, text: list[int]) -> Iterator[tuple[int, set[str]]]:
        """Start of each occurrence, and the items that it stands for."""
        shift, longest, n, length = self.shift.get, self.longest, len(text), self.length
        at = length - 1
        while at < n:
            last = text[at]
            if not last:  # a word of no pattern: no window may contain it
                at += length
                continue
            key = (text[at - 1], last) if self.block == 2 else last
            step = shift(key, longest)
            if step:
                at += step
                continue
            start = at - length + 1
            for pattern, items in self.buckets[key].get(text[start], ()):
                if tuple(text[start : at + 1]) == pattern:
                    yield start, items
            at += 1


class Benchmark:
    """Vocabulary and searchers of one shard of items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, found in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found]
            length = min(window, len(numbers))
            for at in range(len(numbers) - length + 1 if length else 0):
                by_length.setdefault(length, {}).setdefault(tuple(numbers[at : at + length]), set()).add(item)
        self.searchers = [Searcher(length, patterns) for length, patterns in sorted(by_length.items())]

    def search(self, found: list[bytes], hit: np.ndarray, items: set[str]) -> None:
        """Marks the words hit and adds the items that occur."""
        number = self.vocabulary.get
        text = [number(w, 0) for w in found]
        for searcher in self.searchers:
            for start, own in searcher.find(text):
                hit[start : start + searcher.length] = True
                items.update(own)


def benchmark_parts(benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """A stored table of shard, item and words (with blanks between them), at most ``shard_words`` words a shard.

    Each task fills shards of its own. A longer item is cut into parts that overlap by a window less one word, so no window
    is lost. Items without words have no part.
    """
    texts = benchmark.select(F.col("item_id").cast("string"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = 1 + size // (SHARD_BYTES_A_WORD * shard_words)
    step = max(1, shard_words - window + 1)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            shard, size = TaskContext.get().partitionId() << 32, 0
            for batch in parts:
                for item, text in rows_of(batch):
                    own = words(text)
                    for at in range(0, max(1, len(own) - window + 1), step) if own else ():
                        part = own[at : at + step + window - 1]
                        if size and size + len(part) > shard_words:
                            shard, size = shard + 1, 0
                        size += len(part)
                        yield shard, item, b" ".join(part)

        yield from batches(found(), _PARTS)

    return stored(texts.coalesce(tasks).mapInArrow(work, PARTS), "benchmark-parts")


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, n_hit, n_items, items and contaminated.

    A word is hit if it lies in an occurrence of any window of any item. ``items`` are the ids of
    the items found, as text in text order; a null id counts as no item, though its words are hit. A null or empty
    text has no words; a null or empty item matches nothing. Repeated rows and items are
    each judged. Columns of the same names are replaced. Words over the whole text, whatever its length.
    """
    spark = docs.sparkSession
    kept = others(docs, "n_words", "n_hit", "n_items", "items", "contaminated", "hits", keep=keep)
    parts = benchmark_parts(benchmark, window, shard_words)
    shards = sorted(r["shard"] for r in parts.select("shard").distinct().collect())
    # A text that is kept goes to the tasks once.
    result, held = docs.select(*kept) if "text" in kept else docs.select(*kept, F.col("text").alias("__text")), None
    for shard in shards or [0]:
        if held:
            result = stored(result, "benchmark-pass")
            held.destroy()
        own = parts.where(F.col("shard") == shard).select("item", "words").collect()
        first = held is None
        held = spark.sparkContext.broadcast(Benchmark([(item, bytes(found).split()) for item, found in own], window))
        result = _pass(result, held, first)
    return result.select(
        *kept,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _pass(docs: DataFrame, shard, first: bool) -> DataFrame:
    """One shard over all documents. The words hit so far travel along as packed bits."""
    plain = docs.schema.fields[:] if first else docs.schema.fields[:-4]
    schema = T.StructType(plain[:]).add("n_words", "long").add("n_hit", "long").add("hits", "binary").add("items", T.ArrayType(T.StringType()))
    n, text_name = len(plain), "text" if any(f.name == "text" for f in plain) else "__text"

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            at_text = batch.schema.get_field_index(text_name)
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = part.column(at_text).to_pylist()
                before = zip(part.column(n + 2).to_pylist(), part.column(n + 3).to_pylist(), strict=True) if not first else ((None, ()) for _ in texts)
                n_words, n_hit, hits, names = [], [], [], []
                for text, (bits, items) in zip(texts, before, strict=True):
                    found = words(text)
                    hit = np.zeros(len(found), bool) if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), count=len(found)).astype(bool)
                    seen = set(items)
                    shard.value.search(found, hit, seen)
                    n_words.append(len(found))
                    n_hit.append(int(hit.sum()))
                    hits.append(np.packbits(hit).tobytes() if hit.any() else None)
                    names.append(sorted(x for x in seen if x is not None))
                columns = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hits, pa.binary()), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], names=[*part.schema.names[:n], "n_words", "n_hit", "hits", "items"])

    return docs.mapInArrow(search, schema)


def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    return marked.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without any benchmark window."""
    return shielded(docs, lambda d: mark_contamination(d, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")))
