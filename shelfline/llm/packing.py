"""Cost-balanced packing of tokenized documents into sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n``: attention within a document is
quadratic in its length, all else is linear. Documents longer than a sequence first give full sequences;
what is left over is gathered to blocks of about ``block_tokens`` tokens. A block opens as
many sequences as its tokens fill, takes its pieces by descending cost, and puts each into the
sequence of lowest cost that still has room for it. A piece that fits nowhere is cut at the
largest room left. The tokens beyond the last full sequence of a block go to sequences whose lengths
are powers of two, which need no padding.

Blocks are made from the rows that a task reads, so nothing is shuffled and no task holds more than a block and
the document at hand. A tokenizer splits at white space in any case, so each distinct word is
encoded once and its ids are reused.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import batches, table

SEQUENCE = 4096
END_ID = 2
BLOCK_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
CACHED_CHARACTERS = 5 << 20
JOINED_WORDS = 256

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_length long"
_SCHEMA = pa.schema([(f.split()[0], pa.binary() if f.endswith("binary") else pa.int64()) for f in PIECES.split(", ")])


class WordEncoder:
    """Token ids of texts, through a table of the words seen so far.

    Only blanks and line feeds separate words here: the tokenizer drops both, and treats all
    that stands between them on its own. When its words grow past a bound, the table keeps those found in several
    batches of texts, up to half the bound; most distinct words of a corpus occur once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A special token stands for itself wherever it is found, so it can hold words apart.
        apart = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.normalized or t.single_word or t.lstrip or t.rstrip)]
        self.mark, self.mark_text = min(apart, default=(-1, ""))
        # Ids that close a stretch of letters, and closing marks that are one id; none if the vocabulary doesn't show ends.
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.closes[[i for entry, i in vocabulary.items() if suffix and entry.endswith(suffix)]] = True
        self.marks = {c: vocabulary[c + suffix] for c in ".,!?;:" if suffix and c + suffix in vocabulary}
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {"": 0}
        self.characters = 0
        self.flat = np.zeros(0, np.uint32)
        self.length = self.first = np.zeros(1, np.int64)
        self.batches = np.zeros(1, np.int32)  # how many batches of texts held the word

    def shrink(self, characters: int) -> None:
        """Leaves the words found in the most batches of texts, two at least, of at most so many characters together."""
        words = list(self.codes)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 8
        held = np.minimum(self.batches, 1000)
        by_batches = np.cumsum(np.bincount(held, size)[::-1])[::-1]  # characters of words found in so many batches or more
        enough = np.flatnonzero(np.append(by_batches, 0) <= characters)
        keep = held >= max(2, enough[0])
        keep[0] = True
        chosen = np.flatnonzero(keep)
        length = self.length[chosen]
        ends = np.cumsum(length)
        self.flat = self.flat[np.repeat(self.first[chosen] - ends + length, length) + np.arange(ends[-1])]
        self.first, self.length = ends - length, length
        # Words not met again lose their place in the end.
        self.batches = self.batches[chosen] // 2
        self.codes = dict(zip([words[i] for i in chosen.tolist()], range(len(chosen)), strict=True))
        self.characters = int(size[chosen].sum())

    def _add(self, words: list[str]) -> None:
        """Encodes words that are not in the table: letters, with or without one closing mark, as the letters' ids and the mark's."""
        marks = self.marks
        letters = [w if _of_letters(w) else w[:-1] if w[-1] in marks and _of_letters(w[:-1]) else "" for w in words]
        bases = list(set(letters).difference([""]))
        place = dict(zip(bases, range(len(bases)), strict=True)) if bases else {}
        other = [w for w, own in zip(words, letters, strict=True) if not own]
        found = [self._encoded_letters(bases[at : at + JOINED_WORDS]) for at in range(0, len(bases), JOINED_WORDS)]
        found.append(self._encoded(other))
        flat = np.concatenate([ids for ids, _ in found])
        length = np.concatenate([n for _, n in found])
        first = np.cumsum(length) - length
        # Which of what was encoded each word begins with, and the mark it ends with.
        rest = iter(range(len(bases), len(bases) + len(other)))
        base = np.fromiter((place[own] if own else next(rest) for own in letters), np.int64, len(words))
        mark = np.fromiter((marks[w[-1]] if own and len(own) < len(w) else -1 for w, own in zip(words, letters, strict=True)), np.int64, len(words))
        total = length[base] + (mark >= 0)
        ends = np.cumsum(total)
        at = np.repeat(first[base] - ends + total, total) + np.arange(ends[-1])
        own_flat = np.append(flat, np.uint32(0))[np.minimum(at, len(flat))]
        own_flat[ends[mark >= 0] - 1] = mark[mark >= 0]

        self.codes.update(zip(words, range(len(self.codes), len(self.codes) + len(words)), strict=True))
        self.characters += sum(map(len, words)) + 8 * len(words)
        self.first = np.concatenate([self.first, len(self.flat) + ends - total])
        self.length = np.concatenate([self.length, total])
        self.flat = np.concatenate([self.flat, own_flat])
        self.batches = np.concatenate([self.batches, np.zeros(len(words), np.int32)])

    def _encoded_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each of some words of letters only: the ids of a word end with one that closes it."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.flatnonzero(self.closes[ids])
        if len(ends) != len(words):  # some letter is none to the tokenizer
            return self._encoded(words)
        return ids.astype(np.uint32), np.diff(ends, prepend=-1)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each of some words, many in one call with a special token between them."""
        # A word that has the token's text in it goes by itself.
        alone = [w for w in words if self.mark_text in w]
        plain = [w for w in words if self.mark_text not in w] if alone else words
        joined = [self.mark_text.join([*plain[at : at + JOINED_WORDS], ""]) for at in range(0, len(plain), JOINED_WORDS)]
        found = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast([*joined, *alone], add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.uint32), *found[: len(joined)]])
        ends = np.flatnonzero(ids == self.mark)
        lengths = iter(np.diff(ends, prepend=-1) - 1)
        by_itself = iter(found[len(joined) :])
        if not alone:
            return np.delete(ids, ends), np.fromiter(lengths, np.int64, len(words))
        starts = iter(np.append(0, ends[:-1] + 1))
        parts = [next(by_itself) if self.mark_text in w else ids[(at := next(starts)) : at + next(lengths)] for w in words]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(words))

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; a null text has none. The texts' distinct words are looked up once, together."""
        # The tokenizer lower-cases; letters beyond ASCII are left to it.
        split = pc.split_pattern(pc.ascii_lower(pc.replace_substring(texts.fill_null(""), "\n", " ")), " ")
        found = split.flatten().dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.characters > CACHED_CHARACTERS:
            self.shrink(CACHED_CHARACTERS // 2)
        own = np.fromiter(map(self.codes.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(own < 0)
        if len(unknown):
            # Words get the next codes in their order.
            own[unknown] = np.arange(len(self.codes), len(self.codes) + len(unknown))
            self._add([distinct[i] for i in unknown.tolist()])
        self.batches[own] += 1
        code = own[found.indices.to_numpy()]
        length = self.length[code]
        ends = np.cumsum(length)
        ids = self.flat[np.repeat(self.first[code] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]
        last = np.append(0, ends)[np.cumsum(pc.list_value_length(split).to_numpy())]
        for low, high in zip(np.append(0, last[:-1]).tolist(), last.tolist(), strict=True):
            yield ids[low:high]


def _of_letters(word: str) -> bool:
    """Letters only, and such as stay letters in lower case and in composed form."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0530" and "İ" not in word))


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def powers(n: int) -> list[int]:
    """Powers of two that add up to n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_block(pieces: list[tuple[int, int]], sequence: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """Places (piece, tokens taken, sequence number, offset) and the lengths of the sequences.

    ``pieces`` are (key, length) with lengths from 1 to ``sequence``; their tokens fill the sequences exactly.
    """
    total = sum(n for _, n in pieces)
    sizes = [sequence] * (total // sequence) + powers(total % sequence)
    room = np.array(sizes, np.int64)
    cost = np.zeros(len(sizes))
    placed = []
    # Lengths give the order, since cost rises with length; a list for each length takes back what was cut off.
    waiting: dict[int, list[int]] = {}
    for key, n in pieces:
        waiting.setdefault(n, []).append(key)
    for n in range(max(waiting, default=0), 0, -1):
        for key in waiting.get(n, ()):
            fits = np.flatnonzero(room >= n)
            if len(fits):
                at, taken = int(fits[cost[fits].argmin()]), n
            else:
                at = int(room.argmax())
                taken = int(room[at])
                waiting.setdefault(n - taken, []).append(key)
            placed.append((key, taken, at, sizes[at] - int(room[at])))
            room[at] -= taken
            cost[at] += linear * taken + quadratic * taken * taken
    return placed, sizes


def pack(
    docs: DataFrame,
    tokenizer: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id,
    offset, sequence_length.

    A null or empty text is the end id alone. Repeated rows are packed each on its own, with the same doc_id. Texts
    of any length are encoded whole. Other columns of ``docs`` are not read. ``tokenizer`` is a file all executors have;
    ``sequence`` is a power of two.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker that has run other jobs gives their memory back before the tables of this one grow.
        pa.default_memory_pool().release_unused()
        task = TaskContext.get().partitionId() << 32
        opened = 0
        held: list[tuple] = []
        tokens = 0

        def packed() -> Iterator[tuple]:
            nonlocal opened
            # A piece's tokens are handed out from its start on, in the order in which they were placed.
            places, sizes = pack_block([(i, len(p[2])) for i, p in enumerate(held)], sequence, linear, quadratic)
            given = [0] * len(held)
            for i, taken, at, offset in places:
                doc_id, start, ids, n = held[i]
                own = ids[given[i] : given[i] + taken]
                yield doc_id, start + given[i], taken, own.tobytes(), n, task + opened + at, offset, sizes[at]
                given[i] += taken
            opened += len(sizes)

        def pieces() -> Iterator[tuple]:
            nonlocal opened, tokens, held
            for batch in parts:
                for ids_of, texts in _groups(batch):
                    for doc_id, ids in zip(ids_of.to_pylist(), encoder(tokenizer).encode(texts), strict=True):
                        ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                        n = len(ids)
                        full = n - n % sequence
                        for start in range(0, full, sequence):
                            yield doc_id, start, sequence, ids[start : start + sequence].tobytes(), n, task + opened, 0, sequence
                            opened += 1
                        if full < n:
                            held.append((doc_id, full, ids[full:], n))
                            tokens += n - full
                        if tokens >= block_tokens:
                            yield from packed()
                            held, tokens = [], 0
            if held:
                yield from packed()
                held = []

        try:
            yield from batches(pieces(), _SCHEMA)
        finally:  # the worker goes on to other jobs
            encoder(tokenizer).shrink(CACHED_CHARACTERS // 2)
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, PIECES)


def _groups(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[list[pa.Array]]:
    """The columns of a batch, in stretches of about so many bytes of text; a longer text goes by itself."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)))
        yield batch.slice(at, end - at).columns
        at = end


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of the documents, with their ids."""
    return pack(docs, default_tokenizer())
