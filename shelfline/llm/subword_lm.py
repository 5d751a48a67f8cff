"""Scores of texts by the marginal likelihood of all their segmentations.

The subword vocabulary is that of an existing tokenizer (a parameter). Its pieces get unigram probabilities: counts
of the pieces in the training words, plus a share for each piece by its rank in the vocabulary's own
scores, so that no piece is impossible. A word is a lattice: every way to spell it with pieces, bytes
included for what no piece covers. The forward recursion adds up, in log space, the probabilities of all paths
to each place; at the end stands the word's marginal probability. A text is its words and an
end piece. Pieces never span words, so words are scored each by itself and a word once per corpus.

Tables, and what they hold:

* ``chunks``: per task's share of documents, a few million words, the documents as codes of the share's own
  distinct words, and those words with their number in training documents;
* word counts: the shares' words added up by word. A word in a third of all documents comes once from each share;
* the answers go back to the shares: per distinct word the count and the marginal log-probability, and each share's
  documents are summed with them.

No task holds more than a share and its distinct words, and the vocabulary, whose size is fixed, is all that is broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import ascii_lower, batches, by_key, held_out, rows_of, stored, table

CHUNK_WORDS = 4 << 20
PRIOR_TOKENS = 10_000.0
_BEGUN = math.inf
MARK = "▁"  # stands before a word in the vocabulary's pieces

CHUNKS = "chunk long, doc_id long, held_out boolean, n_words long, codes binary, word binary, code int, n long"
ANSWERS = "chunk long, code int, n long, lp double"
SCORED = "doc_id long, held_out boolean, n_words long, n_known long, base double, lp double"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def split_chunks(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Stored rows of two kinds for each chunk: documents (``codes``) and distinct words (``word``).

    ``docs`` has doc_id, held_out and text.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 32, 0
        known: dict[bytes, int] = {}
        rows: list[tuple] = []
        n_words = 0
        squeeze = zstandard.ZstdCompressor(level=1).compress

        def closed() -> Iterator[tuple]:
            counts = np.zeros(len(known), np.int64)
            for _, held_out, codes in rows:
                if not held_out:
                    counts += np.bincount(codes, minlength=len(known)) if len(codes) > len(known) // 8 else 0
                    if len(codes) <= len(known) // 8:
                        np.add.at(counts, codes, 1)
            chunk = task + number
            for doc_id, held_out, codes in rows:
                yield chunk, doc_id, held_out, len(codes), squeeze(codes.tobytes()), None, None, None
            for word, code in known.items():
                yield chunk, None, None, None, None, word, code, int(counts[code])

        def found() -> Iterator[tuple]:
            nonlocal number, known, rows, n_words
            for batch in parts:
                for doc_id, held_out, text in rows_of(batch):
                    words = ascii_lower(text).split()
                    codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))
                    rows.append((doc_id, held_out, codes))
                    n_words += len(words) + 16
                    if n_words >= chunk_words:
                        yield from closed()
                        number, known, rows, n_words = number + 1, {}, [], 0
            if rows:
                yield from closed()

        yield from batches(found(), _schema(CHUNKS), size=1 << 14)

    return stored(docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(work, CHUNKS), "word-chunks")


@dataclass
class Vocabulary:
    """Natural logarithms of piece probabilities, the end piece among them."""

    pieces: dict[str, float]
    byte: list[float]
    end: float

    def __post_init__(self):
        # Beginnings of pieces that are no pieces themselves: a search along a word ends where neither goes on.
        begun = {piece[:n]: _BEGUN for piece in self.pieces for n in range(1, len(piece))}
        self.steps = begun | self.pieces
        self.characters: dict[str, float] = {}

    def spelled(self, character: str) -> float:
        """log of the probability of a character's bytes, as pieces of their own."""
        cost = self.characters.get(character)
        if cost is None:
            cost = self.characters[character] = sum(self.byte[b] for b in character.encode())
        return cost

    def word(self, word: bytes) -> float:
        """log of the sum over all segmentations: forward recursion over the characters of the word.

        For each place the greatest log-probability of a path to it, and the sum of all paths relative to that one.
        """
        text = MARK + word.decode("utf-8", "replace")
        n, step, exp, log = len(text), self.steps.get, math.exp, math.log
        top, rest = [-math.inf] * (n + 1), [0.0] * (n + 1)
        top[0], rest[0] = 0.0, 1.0
        for start in range(n):
            here = top[start] + log(rest[start])
            # The bytes of one character lead on from every place, so each place is reached.
            path, end = here + self.spelled(text[start]), start + 1
            off = path - top[end]
            if off <= 0.0:
                if off > -40.0:  # less changes no digit
                    rest[end] += exp(off)
            else:
                rest[end] = 1.0 + (rest[end] * exp(-off) if off < 40.0 else 0.0)
                top[end] = path
            for end in range(start + 1, n + 1):
                p = step(text[start:end])
                if p is None:
                    break
                if p == _BEGUN:
                    continue
                path = here + p
                off = path - top[end]
                if off <= 0.0:
                    if off > -40.0:
                        rest[end] += exp(off)
                else:
                    rest[end] = 1.0 + (rest[end] * exp(-off) if off < 40.0 else 0.0)
                    top[end] = path
        return top[n] + log(rest[n])


def _tokenizer(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def train_vocabulary(chunks: DataFrame, path: str, prior_tokens: float = PRIOR_TOKENS) -> Vocabulary:
    """Piece probabilities from all training words. The counts that come to the driver are one per piece."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, counts = _tokenizer(path), Counter()
        for batch in parts:
            words = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            for ids, n in zip(tokenizer.encode(words, num_threads=1), batch.column(1).to_pylist(), strict=True):
                for i in ids:
                    counts[i] += n
        yield from batches(counts.items(), pa.schema([("piece", pa.int64()), ("n", pa.int64())]))

    words = chunks.where("word is not null and n > 0").select("word", "n")
    counted = words.mapInArrow(work, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    counts = {r["piece"]: r["n"] for r in counted.collect()}
    counts_end = chunks.where("codes is not null and not held_out").count()
    tokenizer = _tokenizer(path)
    size = tokenizer.get_piece_size()
    usable = [i for i in range(size) if not (tokenizer.is_control(i) or tokenizer.is_unknown(i) or tokenizer.is_unused(i))]
    # The vocabulary's own scores fall with the rank; shares of the prior fall as one over the rank.
    ranked = sorted(usable, key=lambda i: (tokenizer.is_byte(i), -tokenizer.get_score(i), i))
    prior = {i: 1.0 / (rank + 10) for rank, i in enumerate(ranked)}
    scale = prior_tokens / sum(prior.values())
    total = sum(counts.get(i, 0) for i in usable) + counts_end + prior_tokens + 1
    logs = {i: math.log((counts.get(i, 0) + prior[i] * scale) / total) for i in usable}
    pieces = {tokenizer.id_to_piece(i): logs[i] for i in usable if not tokenizer.is_byte(i)}
    # A piece that goes on past a blank can't be part of one word.
    pieces = {p: v for p, v in pieces.items() if MARK not in p[1:]}
    byte = [logs[tokenizer.piece_to_id(f"<0x{b:02X}>")] for b in range(256)]
    return Vocabulary(pieces, byte, math.log((counts_end + 1) / total))


def _answers(chunks: DataFrame, vocabulary) -> DataFrame:
    """Per chunk and code: the word's training count and marginal log-probability.

    A chunk of -1 carries, in ``n``, the number of different training words of one task.
    """
    total = F.sum("n").over(Window.partitionBy("word"))
    words = chunks.where("word is not null").select("word", "chunk", "code", "n").withColumn("n", total)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        different = 0

        def found() -> Iterator[tuple]:
            nonlocal different
            last, lp = None, 0.0
            for batch in parts:
                # Rows of a word stand together, so each is spelled out once.
                for word, chunk, code, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if word != last:
                        last, lp = word, vocabulary.value.word(word)
                        different += n > 0
                    yield chunk, code, n, lp
            yield -1, 0, different, 0.0

        yield from batches(found(), _schema(ANSWERS), size=1 << 15)

    return stored(words.mapInArrow(work, ANSWERS), "word-answers")


def _summed(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Per document the sums over its words. Rows of a chunk meet in one task, words first."""
    words = answers.where("chunk >= 0").selectExpr(
        "chunk", "0 as kind", "code", "n", "lp", "null as doc_id", "null as held_out", "null as n_words", "null as codes"
    )
    docs = chunks.where("codes is not null").selectExpr(
        "chunk", "1 as kind", "null as code", "null as n", "null as lp", "doc_id", "held_out", "n_words", "codes"
    )
    ordered = words.unionByName(docs).repartition("chunk").sortWithinPartitions("chunk", "kind")

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress

        def columns() -> Iterator[tuple]:
            """Words of a chunk come as arrays, documents row by row."""
            for batch in parts:
                kind, chunk = np.array(batch.column(1)), np.array(batch.column(0))
                edges = np.flatnonzero((np.diff(kind) != 0) | (np.diff(chunk) != 0)) + 1
                for low, high in zip(np.append(0, edges), np.append(edges, batch.num_rows), strict=True):
                    if high > low:
                        yield int(chunk[low]), int(kind[low]), batch.slice(low, high - low)

        def found() -> Iterator[tuple]:
            for _, own in by_key(columns()):
                held: list[tuple] = []
                logs = lps = known = None
                for _, kind, part in own:
                    if kind == 0:
                        held.append(tuple(np.array(part.column(i)) for i in (2, 3, 4)))
                        continue
                    if logs is None:
                        if held:
                            code, n, lp = (np.concatenate(x) for x in zip(*held, strict=True))
                        else:
                            code, n, lp = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)
                        logs, lps, known = (np.zeros(len(code)) for _ in range(3))
                        logs[code], lps[code], known[code] = np.log10(n + 0.1), lp, n > 0
                        held = []
                    for doc_id, held_out, n_words, codes in zip(*(part.column(i).to_pylist() for i in (5, 6, 7, 8)), strict=True):
                        at = np.frombuffer(unpack(codes), np.int32)
                        yield doc_id, held_out, n_words, int(known[at].sum()), float(logs[at].sum()), float(lps[at].sum())

        yield from batches(found(), _schema(SCORED))

    return ordered.mapInArrow(work, SCORED)


def score_texts(docs: DataFrame, tokenizer: str, training, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Rows where ``training`` (a column) is false are held out; the others are learned from. A text's tokens are its words,
    A-Z lower-cased, and one end. ``base_score`` is the smoothed word-unigram log10 probability, ``score`` the log10
    of the lattice's marginal probability. A null or empty text is the end alone. Repeated rows count and are scored
    each. Without training rows all counts are 0. Other columns are not read.
    """
    spark = docs.sparkSession
    chunks = split_chunks(docs.select("doc_id", (~training).alias("held_out"), "text"), chunk_words)
    vocabulary = train_vocabulary(chunks, tokenizer)
    answers = _answers(chunks, spark.sparkContext.broadcast(vocabulary))
    different = answers.where("chunk = -1").agg(F.sum("n")).first()[0] or 0
    learned = chunks.where("codes is not null and not held_out").agg(F.count(F.lit(1)), F.sum("n_words")).first()
    ends = learned[0]
    tokens = (learned[1] or 0) + ends
    different += 1 if ends else 0
    shared = math.log10(tokens + 0.1 * (different + 1))
    n_tokens = F.col("n_words") + 1
    return _summed(chunks, answers).select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("n_known") + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(ends + 0.1) - n_tokens * shared).alias("base_score"),
        ((F.col("lp") + vocabulary.end) / math.log(10)).alias("score"),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents. No unigram vocabulary with scores is at hand: the pieces are those of a merging tokenizer,
    whose scores are ranks, and their weights are counts over the training words' best segmentations with a prior by rank."""
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, default_tokenizer(), ~held_out(F.col("doc_id"), 10, 0))
