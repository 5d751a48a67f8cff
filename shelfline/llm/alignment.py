"""Alignment of two tokenizers over the same texts.

Tokens of both become byte ranges. An as-of join (``pandas.merge_asof``, keyed by document) finds for each token start the
token of the other side that covers it; of two tokens that overlap, one starts within the other, so the joins of both
directions together are exactly the overlaps, and those with equal starts are found twice. Where tokens of both sides end together,
a group ends.

What a pair of ids counts for, in how many documents it occurs linked, is known only once all documents are aligned. Documents
lie in blocks of about ``BLOCK`` characters; a block keeps its distinct pairs once and of each document the numbers of
its pairs there. The pairs of all blocks are added up, by Spark, and go back to the blocks that hold them; a block and
its counts meet in one task. So nothing is broadcast, a common pair is one row a block, and no step shuffles tokens.

Both tokenizers end a token before a blank between two other characters, whatever is around it. Texts are split there,
each distinct stretch is encoded once for as long as it stays in a bounded table, and very long texts are aligned window by window.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import batches, rows_of, stored, table
from shelfline.operators.lookups import join_folded

WINDOW = 1 << 18  # characters that are aligned at once
BLOCK = 1 << 22
TABLE_STRETCHES = 200_000
JOINED = 8192

_STRETCH = re.compile(r"(?<=\S) (?=\S)")
PARTS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary, codes binary, docs binary"
_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from 256 on."""
    shown = [b for first, last in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(first), ord(last) + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level vocabulary; special strings in texts are plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        alphabet = byte_alphabet()
        self.size = max(vocabulary.values(), default=-1) + 1
        self.bytes = [b""] * self.size
        for entry, i in vocabulary.items():
            if all(c in alphabet for c in entry):
                self.bytes[i] = bytes(alphabet[c] for c in entry)

    def ids(self, stretches: list[str]) -> list[list[int]]:
        """Ids of a blank and the stretch."""
        return [x.ids for x in self.model.encode_batch_fast([" " + s for s in stretches], add_special_tokens=False)]


class Pieces:
    """A piece vocabulary that puts a blank before every text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self.bytes = [bytes([int(self.model.id_to_piece(i)[1:-1], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(self.size)]

    def ids(self, stretches: list[str]) -> list[list[int]]:
        return self.model.encode(stretches, num_threads=1)


class Stretches:
    """Ids of stretches on both sides, in a table that is emptied when it has grown past a bound."""

    def __init__(self, a_path: str, b_path: str):
        self.sides = [ByteLevel(a_path), Pieces(b_path)]
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in self.sides]
        # Decimal ids with what follows them: a comma within a side, a bar between the sides, a semicolon between groups.
        self.texts = [f"{i}{mark}" for side, marks in zip(self.sides, ((",", "|"), (",", ";")), strict=True) for i in range(side.size) for mark in marks]
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.flat = [np.zeros(0, np.int32) for _ in self.sides]
        self.first = [np.zeros(0, np.int64) for _ in self.sides]
        self.length = [np.zeros(0, np.int64) for _ in self.sides]

    def add(self, stretches: Iterable[str]) -> None:
        new = set(stretches).difference(self.codes)
        # Stretches with white space at an end, which only a text's first and last can have, don't stand beside others.
        odd = [s for s in new if s[0].isspace() or s[-1].isspace()]
        plain = list(new.difference(odd))
        for at in range(0, len(plain), JOINED):
            self._add(plain[at : at + JOINED])
        for stretch in odd:
            self._add([stretch])

    def _add(self, new: list[str]) -> None:
        """Encodes stretches as one text: tokens end where they meet. Those that can't be spelled are found one by one."""
        joined = " ".join(new)
        expected = (" " + joined).encode("utf-8", "replace")
        found = [np.array(side.ids([joined])[0], np.int32) for side in self.sides]
        good = all(b"".join(map(side.bytes.__getitem__, ids.tolist())) == expected for side, ids in zip(self.sides, found, strict=True))
        if not good and len(new) > 1:
            for stretch in new:
                self._add([stretch])
            return
        first = len(self.codes)
        self.codes.update(zip(new, range(first, first + len(new)), strict=True))
        self.good = np.append(self.good, np.full(len(new), good))
        ends = np.cumsum([1 + len(s) if s.isascii() else 1 + len(s.encode("utf-8", "replace")) for s in new])
        for i, ids in enumerate(found):
            # After how many tokens each stretch is spelled out.
            last = np.searchsorted(np.cumsum(self.sizes[i][ids]), ends) + 1 if good else np.array([len(ids)])
            self.first[i] = np.concatenate([self.first[i], len(self.flat[i]) + np.append(0, last[:-1])])
            self.length[i] = np.concatenate([self.length[i], np.diff(last, prepend=0)])
            self.flat[i] = np.concatenate([self.flat[i], ids])

    def numbers(self, stretches: list[str]) -> np.ndarray:
        return np.fromiter(map(self.codes.__getitem__, stretches), np.int64, len(stretches))

    def tokens(self, side: int, codes: np.ndarray) -> np.ndarray:
        length = self.length[side][codes]
        ends = np.cumsum(length)
        at = np.repeat(self.first[side][codes] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[side][at]


@lru_cache(maxsize=1)
def stretches(a_path: str, b_path: str) -> Stretches:
    return Stretches(a_path, b_path)


def _covering(own: pd.DataFrame, other: pd.DataFrame) -> np.ndarray:
    """For each token of ``own`` the number of the token of ``other`` that covers its start."""
    return pd.merge_asof(own[["doc", "at"]], other, on="at", by="doc")["token"].to_numpy(np.int64)


def align_window(known: Stretches, docs: list[np.ndarray]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Alignment of documents given as numbers of stretches: their counts (n_a, n_b, n_groups, n_links),
    their groups as texts, and distinct (document, pair) with the times they occur. Each has tokens on both sides."""
    codes = np.concatenate(docs)
    doc_of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    ids, sides = [], []
    for i in range(2):
        own = known.tokens(i, codes)
        size = known.sizes[i][own]
        ids.append(own)
        sides.append(pd.DataFrame({"at": np.cumsum(size) - size, "doc": np.repeat(doc_of, known.length[i][codes]), "token": np.arange(len(own))}))
    covers = [_covering(sides[0], sides[1]), _covering(sides[1], sides[0])]
    starts = [side["at"].to_numpy() for side in sides]
    same = [starts[0] == starts[1][covers[0]], starts[1] == starts[0][covers[1]]]

    # Groups: a start that both sides share opens one.
    firsts = [np.flatnonzero(s) for s in same]
    group = [np.cumsum(s) - 1 for s in same]
    total = [len(x) for x in ids]
    place_a = np.arange(total[0]) + firsts[1][group[0]]
    place_b = np.arange(total[1]) + np.append(firsts[0], total[0])[group[1] + 1]
    last = [np.append(s[1:], True) for s in same]
    written = np.empty(sum(total), np.int64)
    written[place_a] = ids[0] * 2 + last[0]
    written[place_b] = 2 * known.sides[0].size + ids[1] * 2 + last[1]

    of = [side["doc"].to_numpy() for side in sides]
    n = [np.bincount(x, minlength=len(docs)) for x in of]
    groups = np.bincount(of[0][same[0]], minlength=len(docs))
    counts = np.stack([n[0], n[1], groups, n[0] + n[1] - groups], 1)
    texts = []
    for low, size in zip((np.cumsum(n[0] + n[1]) - n[0] - n[1]).tolist(), (n[0] + n[1]).tolist(), strict=True):
        texts.append("".join(map(known.texts.__getitem__, written[low : low + size].tolist()))[:-1])

    # Overlaps, each once, as one number for document and pair of ids.
    only = ~same[1]
    a = np.concatenate([ids[0], ids[0][covers[1][only]]]).astype(np.int64)
    b = np.concatenate([ids[1][covers[0]], ids[1][only]])
    keys = (np.concatenate([of[0], of[1][only]]) * known.sides[0].size + a) * known.sides[1].size + b
    return counts, texts, *np.unique(keys, return_counts=True)


class _Block:
    """Documents of one block, aligned; the last may get more windows."""

    def __init__(self, known: Stretches, whole_groups: bool):
        self.known, self.whole_groups = known, whole_groups
        self.pairs = known.sides[0].size * known.sides[1].size
        self.rows: list[list] = []  # doc_id, counts, groups
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, ids: list, docs: list[np.ndarray], goes_on: bool = False) -> None:
        """``goes_on``: the first of ``docs`` continues the last document of the block."""
        first = len(self.rows) - goes_on
        if not goes_on:
            self.rows.extend([i, np.zeros(4, np.int64), [] if self.whole_groups else hashlib.sha256()] for i in ids)
        filled = [n for n, d in enumerate(docs) if len(d)]
        if not filled:
            return
        counts, texts, keys, times = align_window(self.known, [docs[n] for n in filled])
        for n, own, text in zip(filled, counts, texts, strict=True):
            row = self.rows[first + n]
            text = ";" + text if row[1][0] else text
            row[2].append(text) if self.whole_groups else row[2].update(text.encode())
            row[1] += own
        self.keys.append(keys % self.pairs + (np.array(filled)[keys // self.pairs] + first) * self.pairs)
        self.times.append(times)

    def drop_last(self) -> None:
        """The last document has no alignment after all."""
        at = len(self.rows) - 1
        self.rows[at] = [self.rows[at][0], np.zeros(4, np.int64), None]
        keep = [k // self.pairs != at for k in self.keys]
        self.keys = [k[x] for k, x in zip(self.keys, keep, strict=True)]
        self.times = [t[x] for t, x in zip(self.times, keep, strict=True)]

    def output(self, block: int) -> Iterator[tuple]:
        keys, at = np.unique(np.concatenate([np.zeros(0, np.int64), *self.keys]), return_inverse=True)
        times = np.bincount(at, np.concatenate([np.zeros(0, np.int64), *self.times]), len(keys)).astype(np.uint32)
        codes, number = np.unique(keys % self.pairs, return_inverse=True)
        ends = np.searchsorted(keys // self.pairs, np.arange(len(self.rows) + 1))
        held_in = np.bincount(number, minlength=len(codes))
        for n, (doc_id, counts, groups) in enumerate(self.rows):
            own = slice(ends[n], ends[n + 1])
            text = "" if not counts[0] else "".join(groups) if self.whole_groups else groups.hexdigest()
            table = (codes.tobytes(), held_in.astype(np.uint32).tobytes()) if n == 0 and len(codes) else (None, None)
            yield block, doc_id, *counts.tolist(), text, number[own].astype(np.uint32).tobytes(), times[own].tobytes(), *table


def _aligned(rows: Iterator[tuple], known: Stretches, whole_groups: bool, block_size: int, window: int) -> Iterator[tuple]:
    task, number = TaskContext.get().partitionId() << 32, 0
    block, size = _Block(known, whole_groups), 0
    ids: list = []
    docs: list[list[str]] = []
    waiting = 0

    def numbered(split: list[list[str]]) -> list[np.ndarray]:
        """Stretch numbers; nothing for a text whose tokens don't give its bytes on both sides."""
        if len(known.codes) > TABLE_STRETCHES:
            known.clear()
        known.add(s for own in split for s in own)
        found = [known.numbers(own) for own in split]
        return [x if known.good[x].all() else x[:0] for x in found]

    def long_text(text: str) -> None:
        at, goes_on = 0, False
        while at < len(text):
            found = _STRETCH.search(text, at + window)
            end = found.start() if found else len(text)
            (codes,) = numbered([_STRETCH.split(text[at:end])])
            if not len(codes):
                if not goes_on:
                    block.add([doc_id], [codes])
                block.drop_last()
                return
            block.add([doc_id], [codes], goes_on)
            at, goes_on = end + 1 if found else len(text), True

    for doc_id, text in rows:
        if text and len(text) > 2 * window:
            block.add(ids, numbered(docs))
            ids, docs, waiting = [], [], 0
            long_text(text)
        else:
            ids.append(doc_id)
            docs.append(_STRETCH.split(text) if text else [])
            waiting += len(text or "")
        size += len(text or "") + 16
        if waiting >= window or size >= block_size:
            block.add(ids, numbered(docs))
            ids, docs, waiting = [], [], 0
        if size >= block_size:
            yield from block.output(task + number)
            block, size, number = _Block(known, whole_groups), 0, number + 1
    block.add(ids, numbered(docs))
    yield from block.output(task + number)


class Alignment:
    """Documents aligned, in blocks, and the number of documents that hold each pair of ids linked."""

    def __init__(self, blocks: DataFrame, b_size: int):
        self.blocks, self.b_size = blocks, b_size
        entries = blocks.where("codes is not null").select("block", "codes", "docs").mapInArrow(_entries, "block long, number long, code long, docs long")
        self.entries = stored(entries, "alignment-entries")
        self.totals = self.entries.groupBy("code").agg(F.sum("docs").alias("n_docs"))

    def pair_counts(self) -> DataFrame:
        """a_id, b_id, n_docs and best: whether no other pair of this a_id is in more documents."""
        pairs = stored(self.totals.select(F.expr(f"code div {self.b_size}").alias("a_id"), (F.col("code") % self.b_size).alias("b_id"), "n_docs"), "pair-counts")
        highest = pairs.groupBy("a_id").agg(F.max("n_docs").alias("highest"))
        return join_folded(pairs, highest, ["a_id"], "inner").select("a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("highest")).alias("best"))

    def documents(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups."""
        counted = self.pair_counts().select((F.col("a_id") * self.b_size + F.col("b_id")).alias("code"), "n_docs", "best")
        worth = join_folded(self.entries.select("block", "number", "code"), counted, ["code"], "inner").select("block", "number", "n_docs", "best")
        own = self.blocks.drop("codes", "docs")
        columns = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
        return own.groupBy("block").cogroup(worth.groupBy("block")).applyInArrow(_weighed, columns)


def _entries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema("block long, number long, code long, docs long")
    for batch in parts:
        for block, codes, docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            codes, docs = np.frombuffer(codes, np.int64), np.frombuffer(docs, np.uint32).astype(np.int64)
            for at in range(0, len(codes), 1 << 16):
                own = slice(at, at + (1 << 16))
                n = len(codes[own])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array(np.arange(at, at + n)), pa.array(codes[own]), pa.array(docs[own])], schema=schema)


def _weighed(own: pa.Table, worth: pa.Table) -> pa.Table:
    """Adds to the documents of a block what its pairs count for."""
    counts = np.zeros(worth.num_rows, np.int64)
    best = np.zeros(worth.num_rows, np.int64)
    place = worth.column("number").to_numpy()
    counts[place] = worth.column("n_docs").to_numpy()
    best[place] = worth.column("best").to_numpy().astype(np.int64)
    sums: list[int] = []
    highest: list[int] = []
    for pairs, times in zip(own.column("pairs"), own.column("times"), strict=True):
        pairs, times = np.frombuffer(pairs.as_py(), np.uint32), np.frombuffer(times.as_py(), np.uint32).astype(np.int64)
        sums.append(int((counts[pairs] * times).sum()))
        highest.append(int((best[pairs] * times).sum()))
    named = {c: own.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(named | {"n_best": pa.array(highest, pa.int64()), "count_sum": pa.array(sums, pa.int64()), "groups": own.column("groups")})


def align(docs: DataFrame, a_path: str, b_path: str, whole_groups: bool = False, block_size: int = BLOCK, window: int = WINDOW) -> Alignment:
    """Aligns the texts of ``docs``: a blank and the text by the byte-level vocabulary ``a_path``, the text by the piece vocabulary
    ``b_path``. ``groups`` is ``a1,a2|b1;a3|b2,b3`` with ``whole_groups``, else the sha256 of that, and empty for texts without tokens.

    Null and empty texts, and texts whose tokens of either side don't spell them, have no tokens and zeros. Every row is
    a document of its own, so repeated rows count each and a doc_id, also null, may stand on several. Texts are aligned whole, of any
    length. Other columns are not read. No rows give no rows.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = stretches(a_path, b_path)
        rows = (row for batch in parts for row in rows_of(batch))
        try:
            yield from batches(_aligned(rows, known, whole_groups, block_size, window), _schema(PARTS))
        finally:  # the worker goes on to other jobs
            known.clear()
            pa.default_memory_pool().release_unused()

    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).vocab_size()
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, PARTS)
    return Alignment(stored(blocks, "alignment-blocks"), b_size)


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(table(spark, sf_dir, "documents"), *default_tokenizers()).documents()
    return found.withColumnRenamed("groups", "groups_sha256")
