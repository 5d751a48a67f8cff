"""The operators over the whole given tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm.alignment import op12_alignment
from shelfline.llm.contamination import op8_contamination
from shelfline.llm.langid import op7_langid
from shelfline.llm.lexical import OP13_SQL, op13_lexical
from shelfline.llm.line_dedup import OP3_SQL, op3_line_dedup
from shelfline.llm.near_dups import op6_near_dups
from shelfline.llm.packing import op5_packing
from shelfline.llm.repeats import op10_repeats
from shelfline.llm.secrets import op4_secrets
from shelfline.llm.subword_lm import op2_subword_lm
from shelfline.llm.token_counts import op11_token_counts
from shelfline.llm.topk import OP1_SQL, op1_topk
from shelfline.llm.url_rules import OP9_SQL, op9_url_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_topk,
        op2_subword_lm,
        op3_line_dedup,
        op4_secrets,
        op5_packing,
        op6_near_dups,
        op7_langid,
        op8_contamination,
        op9_url_rules,
        op10_repeats,
        op11_token_counts,
        op12_alignment,
        op13_lexical,
    )
}
SQL = {"op1_topk": OP1_SQL, "op3_line_dedup": OP3_SQL, "op9_url_rules": OP9_SQL, "op13_lexical": OP13_SQL}
