"""Token counts of whole texts, without keeping a token.

An Arrow function gets a column of texts and gives back lengths only. Texts are handed to the tokenizer's own batch
call, in batches of about ``BATCH_BYTES``, whatever the number of texts: short ones go together, and a text of
more than ``PART_BYTES`` is split at places where its tokens end in any case, so neither a batch nor a text
decides how much memory a task takes.

Safe places of a byte-level tokenizer without normalizer: before a blank, tab or line end that follows something
else (its pattern lets no stretch run on into white space), between an ASCII letter and a digit, and after
ideographic punctuation. No special token holds any of these. A piece tokenizer of the identity normalizer whose pieces
hold a blank at their beginning only: before a blank that follows something else and is not the last character; that blank is left out, since
the tokenizer puts one before every text. Texts of other tokenizers, and stretches without such a place, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import others, table

BATCH_BYTES = 1 << 20
PART_BYTES = 1 << 16
LIMIT = 512

_BYTE_LEVEL_CUT = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[、。，！？])(?=[一-龥])")
_PIECE_CUT = re.compile(r"(?<=[^ ▁]) (?!\Z)")


def split_safely(text: str, cut: re.Pattern | None, size: int) -> Iterator[str]:
    """Parts of ``text`` whose tokens are those of the text: each is cut at the first safe place past ``size`` characters.
    What the pattern matches is left out between two parts."""
    at = 0
    while cut is not None and len(text) - at > size:
        found = cut.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


class Counter:
    """Numbers of tokens by the library that a vocabulary file is for."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            inner = any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.vocab_size()))
            plain = model.normalize("  a  ﬁ ") == "▁▁▁a▁▁ﬁ▁"
            self.cut = _PIECE_CUT if plain and not inner else None
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            with open(path, encoding="utf-8") as file:
                self.cut = _cut_of(json.load(file))
            self.lengths = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str | None], part_bytes: int = PART_BYTES, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
        """Tokens of each text; null has none."""
        total = np.zeros(len(texts), np.int64)
        owners: list[int] = []
        parts: list[str] = []
        held = 0
        for owner, text in enumerate(texts):
            if not text:
                continue
            for part in split_safely(text, self.cut, part_bytes // 4 if not text.isascii() else part_bytes):
                if not part:
                    continue
                size = len(part) if part.isascii() else len(part.encode("utf-8", "replace"))
                if parts and held + size > batch_bytes:
                    np.add.at(total, owners, self.lengths(parts))
                    owners, parts, held = [], [], 0
                owners.append(owner)
                parts.append(part)
                held += size
        if parts:
            np.add.at(total, owners, self.lengths(parts))
        return total


def _cut_of(spec: dict) -> re.Pattern | None:
    """Where texts of a tokenizer may be split, by its description."""
    before = spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    apart = all(re.search(r"[\s0-9]", t["content"]) is None and not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec.get("added_tokens", ()))
    return _BYTE_LEVEL_CUT if plain and apart else None


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column, tokenizer: str, part_bytes: int = PART_BYTES, batch_bytes: int = BATCH_BYTES) -> Column:
    """Number of tokens of a text column by the vocabulary file ``tokenizer``, which every executor has; 0 for null."""

    @F.arrow_udf("bigint")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(tokenizer)
        for batch in batches:
            # A few hundred texts at a time become Python strings.
            found = [own.count(batch.slice(at, 256).to_pylist(), part_bytes, batch_bytes) for at in range(0, len(batch), 256)]
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *found]), pa.int64())

    return lengths(text)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    A null text counts as empty: no bytes, no tokens. Begin, end and added special tokens aren't counted; special strings in a text are
    what the library's default makes of them. Texts are counted whole, of any length. Repeated rows are counted each; a null id is
    like any other. Columns of the three names are replaced, all others stay; no rows give no rows.
    """
    kept = [F.col(f"`{c}`") for c in others(docs, "n_bytes", "n_tokens", "over_limit")]
    own = docs.withColumn("__n_tokens", token_count(F.col(f"`{text}`"), tokenizer))
    n_bytes = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    return own.select(*kept, n_bytes.alias("n_bytes"), F.col("__n_tokens").alias("n_tokens"), (F.col("__n_tokens") > limit).alias("over_limit"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return count_tokens(docs, default_tokenizer()).select("doc_id", "n_bytes", "n_tokens", "over_limit")
