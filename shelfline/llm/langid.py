"""Language identification by interpolated Kneser-Ney character models.

One model per language, trained on a bounded sample of labelled documents (``SAMPLE_DOCS`` of each
language, whole texts; the smallest hashes of their ids). Texts are lower-cased; every letter of the sample has a number of its own, all
else between letters is one boundary mark, so marks and digits sprinkled over a text change little. Kneser-Ney of order ``ORDER``, whatever
the alphabet: the highest order uses counts, lower orders the number of different characters seen before, with one discount per order
and what it frees going to the next lower order, down to equal shares.

An n-gram is a 64-bit hash of its letters. Two sorted hash arrays hold the n-grams and their contexts, of all orders and languages;
an entry says for which languages it counts and what: an n-gram its discounted share, a context what it leaves to the lower order. The
cross-entropy of a text, per character, is compared between languages, the lowest wins. Rejection is
calibrated on a quarter of the sample left out of training: a text is rejected if its cross-entropy lies further above that
of held-out texts of its language than chance allows at its length, and by more than half of what the nearest other
language's texts cost there; and if it has no letters.

Models are broadcast; their size is bounded by the sample. A task looks each distinct n-gram of a batch of texts up once, order by order,
and keeps nothing from one batch to the next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import held_out, others, shielded, table

SAMPLE_DOCS = 240
ORDER = 5
BATCH_CHARACTERS = 1 << 17
SHARES = 32
DEVIATIONS = 8.0
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PLACES = np.random.default_rng(20_240_707).integers(0, 1 << 63, ORDER, np.uint64) | np.uint64(1)
_SALTS = np.random.default_rng(20_240_708).integers(0, 1 << 63, ORDER + 1, np.uint64)


@dataclass
class Alphabet:
    """Numbers of letters: 0 a boundary, 1 a letter the sample doesn't have, from 2 on the letters of the sample."""

    letters: list[int]
    numbers: np.ndarray

    @classmethod
    def of(cls, counts: dict[str, int]) -> Alphabet:
        letters = sorted(ord(c) for c in counts)
        numbers = np.zeros(0x110000, np.uint32)
        numbers[letters] = np.arange(2, len(letters) + 2)
        return cls(letters, numbers)

    def encode(self, text: str) -> np.ndarray:
        """Letter numbers with each stretch of other characters as one 0."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        own = self.numbers[points]
        unknown = np.flatnonzero((own == 0) & (points >= 0xAA))
        if len(unknown):  # letters that the sample doesn't have
            own = own.copy()
            distinct, back = np.unique(points[unknown], return_inverse=True)
            own[unknown] = np.array([chr(p).isalpha() for p in distinct.tolist()], np.uint32)[back]
        keep = own != 0
        keep[1:] |= own[:-1] != 0
        return own[keep]


def windows(codes: np.ndarray) -> np.ndarray:
    """The last ``ORDER`` letters at each place, a row each; boundaries stand before the first."""
    padded = np.concatenate([np.zeros(ORDER - 1, np.uint32), codes])
    return np.lib.stride_tricks.sliding_window_view(padded, ORDER) if len(codes) else np.zeros((0, ORDER), np.uint32)


def keys_of(rows: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the last ``order`` letters of each row and of the ``order - 1`` before the last."""
    own = np.full(len(rows), _SALTS[order])
    for back in range(1, order):
        own += (rows[:, -1 - back].astype(np.uint64) + np.uint64(1)) * _PLACES[back]
    return own + (rows[:, -1].astype(np.uint64) + np.uint64(1)) * _PLACES[0], own


def _kneser_ney(texts: list[np.ndarray]) -> tuple[list[tuple], list[tuple]]:
    """For each order hashes of n-grams with their discounted shares, and of contexts with what they leave to the lower order."""
    rows = np.concatenate([np.zeros((0, ORDER), np.uint32), *[windows(t) for t in texts]])
    shares, rests = [], []
    for order in range(ORDER, 0, -1):
        keys, contexts = keys_of(rows, order)
        # Below the highest order rows are distinct longer n-grams: a count is how many characters came before.
        keys, first, counts = np.unique(keys, return_index=True, return_counts=True)
        rows, contexts = rows[first], contexts[first]
        ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
        discount = min(0.95, max(0.05, ones / (ones + 2 * twos) if ones + twos else 0.5))
        context, back = np.unique(contexts, return_inverse=True)
        total, types = np.bincount(back, counts, len(context)), np.bincount(back, minlength=len(context))
        shares.append((keys, np.maximum(counts - discount, 0) / total[back]))
        rests.append((context, discount * types / total))
    return shares, rests


class HashArray:
    """Values of hashes by language: sorted hashes, and behind each the languages it has a value for."""

    def __init__(self, by_language: list[list[tuple[np.ndarray, np.ndarray]]]):
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))]
        parts += [(k, np.full(len(k), i), v) for i, own in enumerate(by_language) for k, v in own]
        keys, languages, values = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((languages, keys))
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.length = np.diff(np.append(self.first, len(keys)))
        self.languages, self.values = languages[order].astype(np.uint16), values[order].astype(np.float32)

    def fill(self, wanted: np.ndarray, into: np.ndarray) -> np.ndarray:
        """Writes the values of the hashes ``wanted`` into the rows of ``into``, a column a language."""
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == wanted)
            at = at[hit]
            n = self.length[at]
            places = np.repeat(self.first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
            into[np.repeat(hit, n), self.languages[places]] = self.values[places]
        return into


class Models:
    """The models of all languages."""

    def __init__(self, alphabet: Alphabet, by_language: list[list[np.ndarray]]):
        found = [_kneser_ney(texts) for texts in by_language]
        self.languages = len(found)
        self.size = len(alphabet.letters) + 2
        self.shares = HashArray([shares for shares, _ in found])
        self.rests = HashArray([rests for _, rests in found])

    def log2(self, rows: np.ndarray) -> np.ndarray:
        """log2 of the probability of the last letter of each row after the others, a column a language."""
        # Distinct n-grams of each order, each with the place of its ending among those of the order below.
        levels = []
        for order in range(ORDER, 0, -1):
            keys, contexts = keys_of(rows, order)
            keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
            rows = rows[first]
            levels.append((keys, contexts[first], back))
        p = np.full((1, self.languages), 1.0 / self.size)
        below = np.zeros(len(levels[-1][0]), np.int64)
        for keys, contexts, back in reversed(levels):
            shape = (len(keys), self.languages)
            p = self.shares.fill(keys, np.zeros(shape)) + self.rests.fill(contexts, np.ones(shape)) * p[below]
            below = back
        return np.log2(p)[below]


@dataclass
class LanguageModels:
    alphabet: Alphabet
    names: list[str]
    models: Models
    ceilings: list[tuple[float, float, float, float]]  # mean, spread between texts, spread per character, least excess; in bits

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits per character, a row for each text; texts are codes of at least one letter."""
        lengths = np.array([len(t) for t in texts], np.int64)
        sums = np.zeros((len(texts), len(self.names)))
        # A long text is scored in stretches, so that memory is that of a batch.
        parts = [(i, t, low) for i, t in enumerate(texts) for low in range(0, len(t), BATCH_CHARACTERS)]
        at = 0
        while at < len(parts):
            end, n = at, 0
            while end < len(parts) and (end == at or n + min(len(parts[end][1]) - parts[end][2], BATCH_CHARACTERS) <= BATCH_CHARACTERS):
                n += min(len(parts[end][1]) - parts[end][2], BATCH_CHARACTERS)
                end += 1
            rows = [windows(t[max(0, low - ORDER + 1) : low + BATCH_CHARACTERS])[min(low, ORDER - 1) :] for _, t, low in parts[at:end]]
            sizes = np.array([len(r) for r in rows])
            logs = self.models.log2(np.concatenate(rows))
            np.add.at(sums, [i for i, _, _ in parts[at:end]], np.add.reduceat(logs, np.cumsum(sizes) - sizes, axis=0))
            at = end
        return -sums / lengths[:, None]


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageModels:
    """Models from rows of (doc_id, text, lang), without those that lack a text, a letter or a lang.

    Only the sample's rows come to the driver, at most ``sample_docs`` for a language.
    """
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    # Smallest hashes of each share of a language first, so that no task ranks all ids of a common language.
    ids = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash"), F.pmod(F.hash("doc_id"), F.lit(SHARES)).alias("share")).distinct()
    for group in (("lang", "share"), ("lang",)):
        ids = ids.withColumn("n", F.row_number().over(Window.partitionBy(*group).orderBy("hash", "doc_id"))).where(F.col("n") <= sample_docs)
    chosen = labelled.join(F.broadcast(ids.select("doc_id", "lang")), ["doc_id", "lang"], "left_semi")
    # One text an id, should an id stand on several rows.
    rows = sorted(chosen.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).collect())
    counts: dict[str, int] = {}
    for row in rows:
        for c in row["text"].lower():
            if c.isalpha():
                counts[c] = counts.get(c, 0) + 1
    alphabet = Alphabet.of(counts)
    by_name: dict[str, list[np.ndarray]] = {}
    for row in rows:
        codes = alphabet.encode(row["text"])
        if codes.any():
            by_name.setdefault(row["lang"], []).append(codes)
    names = sorted(by_name)
    apart = {name: texts[::4] if len(texts) >= 8 else [] for name, texts in by_name.items()}
    result = LanguageModels(alphabet, names, Models(alphabet, [[t for i, t in enumerate(by_name[n]) if i % 4 or not apart[n]] for n in names]), [])
    # Costs per character of what was left out, in every language.
    costs = {name: [-result.models.log2(windows(t)) for t in apart[name]] for name in names}
    for at, name in enumerate(names):
        each = [c[:, at] for c in costs[name]]
        if not each:
            result.ceilings.append((math.inf, 0.0, 0.0, 0.0))
            continue
        foreign = [float(np.concatenate([c[:, at] for c in costs[n]]).mean()) for n in names if n != name and costs[n]]
        means = np.array([e.mean() for e in each])
        long = np.array([len(e) >= 100 for e in each])
        between = float(means[long].std()) if long.sum() >= 4 else float(means.std())
        mean, within = float(np.concatenate(each).mean()), float(np.concatenate(each).std())
        # Texts no further off than half the way to the nearest other language are this one, if perhaps odd.
        result.ceilings.append((mean, between, within, (min(foreign) - mean) / 2 if foreign else mean / 2))
    return result


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def identify(docs: DataFrame, models: LanguageModels, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1), bits (cross-entropy per character) and rejected.

    The prediction uses the text only, all of it. A null text, an empty one and one without letters is ``und`` with score 0, and rejected;
    so is every text if there is no model. Equal cross-entropies go to the first language by name. Repeated rows get equal
    results. Columns of the same names are replaced.
    """
    kept = others(docs, "lang_pred", "score", "bits", "rejected", keep=keep)
    # A text that is kept goes to the tasks once.
    source = docs.select(*kept) if "text" in kept else docs.select(*kept, F.col("text").alias("__text"))
    at_text, n_kept = source.columns.index("text" if "text" in kept else "__text"), len(kept)
    schema = T.StructType(source.schema.fields[:n_kept]).add("lang_pred", "string").add("score", "double").add("bits", "double").add("rejected", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker goes from job to job: what others left is given back first, and what this one leaves last.
        pa.default_memory_pool().release_unused()
        models = shared.value
        for batch in parts:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found = _predicted(models, part.column(at_text).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_kept], pa.array(found["lang"], pa.string()), pa.array(found["score"], pa.float64()), pa.array(found["bits"], pa.float64()), pa.array(found["rejected"], pa.bool_())],
                    names=schema.names,
                )
            batch = part = None
            pa.default_memory_pool().release_unused()

    return source.mapInArrow(work, schema)


def _predicted(models: LanguageModels, texts: list[str | None]) -> dict[str, list]:
    n = len(texts)
    found = {"lang": [UNKNOWN] * n, "score": [0.0] * n, "bits": [None] * n, "rejected": [True] * n}
    pairs = [(i, models.alphabet.encode(t)) for i, t in enumerate(texts) if models.names and has_letter(t)]
    pairs = [(i, codes) for i, codes in pairs if len(codes)]
    if not pairs:
        return found
    bits = models.entropies([codes for _, codes in pairs])
    best = bits.argmin(1)
    top = bits[np.arange(len(pairs)), best]
    lengths = np.array([len(codes) for _, codes in pairs])
    # How sure a guess is grows with the length, up to a line or so.
    score = 1 / np.exp2(-(bits - top[:, None]) * np.minimum(lengths, 64)[:, None]).sum(1)
    mean, between, within, least = np.array(models.ceilings).T[:, best]
    rejected = top > mean + np.maximum(least, DEVIATIONS * np.hypot(between, within / np.sqrt(lengths)))
    for row, (i, _) in enumerate(pairs):
        found["lang"][i] = models.names[best[row]]
        found["score"][i], found["bits"][i], found["rejected"][i] = float(score[row]), float(top[row]), bool(rejected[row])
    return found


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    apart = held_out(F.col("doc_id"), 4, 2)
    models = train(docs.where(~apart))
    found = identify(docs, models, keep=("doc_id",))
    return found.select("doc_id", apart.alias("held_out"), "lang_pred", "score", "bits", "rejected")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in one of the languages learned; if there is none to learn, all documents with letters."""
    models = train(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return shielded(docs, lambda own: _keep_text(own, models))


def _keep_text(own: DataFrame, models: LanguageModels) -> DataFrame:
    if not models.names:
        return own.where(F.col("text").rlike(r"\p{L}"))
    return identify(own, models).where(~F.col("rejected"))
