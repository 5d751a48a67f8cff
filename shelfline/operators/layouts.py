"""Date layouts found in the texts themselves, for sources that nobody has described."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.parsing import COMPACT, ISO, US, parse_date
from shelfline.operators.lookups import if_small

DAY_FIRST = "dd/MM/yyyy"
DOTTED = "dd.MM.yyyy"
# Tried in this order; of layouts that fit equally many texts the first is taken.
CANDIDATES = (ISO, US, COMPACT, DOTTED, DAY_FIRST)


def find_layouts(raw: DataFrame, text: str, source: str = "retailer_code", candidates: tuple[str, ...] = CANDIDATES) -> DataFrame:
    """One row per source: ``layout`` fits the most of its texts, ``texts`` and ``fits`` say how many there are and how many it fits.

    ``ambiguous``: another layout fits as many, as month and day can't be told apart before the 13th; ``layout`` is null
    if none fits any. One pass counts all layouts side by side, combined before the shuffle, so a source may hold any share of the rows.
    """
    fits = [F.count_if(parse_date(F.col(text), c).isNotNull()).alias(f"_{i}") for i, c in enumerate(candidates)]
    counted = raw.groupBy(source).agg(F.count(text).alias("texts"), *fits)
    best = F.greatest(*[f"_{i}" for i in range(len(candidates))])
    first = F.coalesce(*[F.when((F.col(f"_{i}") == best) & (best > 0), F.lit(c)) for i, c in enumerate(candidates)])
    equal = sum((F.when(F.col(f"_{i}") == best, 1).otherwise(0) for i in range(len(candidates))), F.lit(0))
    return counted.select(source, first.alias("layout"), "texts", best.alias("fits"), ((equal > 1) & (best > 0)).alias("ambiguous"))


def add_layout(raw: DataFrame, found: DataFrame, source: str = "retailer_code") -> DataFrame:
    """``raw`` with the column ``_layout`` of its source; sources are few, or the join is an ordinary one."""
    own = if_small(found.select(F.col(source).alias("_source"), F.col("layout").alias("_layout")))
    return raw.join(own, F.col(source).eqNullSafe(F.col("_source")), "left").drop("_source")
