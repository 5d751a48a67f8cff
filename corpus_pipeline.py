"""Cleans ``documents`` for training, stage by stage, and packs what is left.

Each stage takes all documents that the one before it kept and is written before the next one reads
it, so a lost executor costs one stage at most. All but the last return the columns of ``documents``:

* language_id: documents without letters, or too far from every language learned, go;
* line_dedup: lines that three or more documents share stay in one of them only;
* near_dups: of each group of near duplicates the document with the smallest id stays;
* decontamination: documents that hold a window of a benchmark item go;
* packing: the documents' token ids in sequences, one row per piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm.common import stored, table
from shelfline.llm.contamination import decontaminate
from shelfline.llm.langid import language_stage
from shelfline.llm.line_dedup import dedup_stage
from shelfline.llm.near_dups import near_dup_stage
from shelfline.llm.packing import pack_stage

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("line_dedup", dedup_stage),
    ("near_dups", near_dup_stage),
    ("decontamination", decontaminate),
    ("packing", pack_stage),
]

# The language models, the similarity of shingle sets and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
