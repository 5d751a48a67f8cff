"""Rows that operators must cope with."""

from __future__ import annotations

LINE = "A line of more than twenty characters, found all over."
LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(40_000))
COPY = "Copies of one text are here, the very same words in each of the rows, again and again and again. " * 4

# (doc_id, text); a doc_id twice, rows twice, null ids, null, empty and blank texts, a very long one.
DOCS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  TWO"), (6, "1234 5678 !!"), (7, LONG), (8, LONG + " end"),
    (9, COPY), (10, COPY), (10, COPY), (11, COPY.upper()), (12, f"{LINE}\nfirst"), (13, f"  {LINE.upper()}\t\nsecond\n{LINE}"),
    (14, f"third\n{LINE}"), (14, "another text under the same id"), (None, f"{LINE}\nno id"), (None, None), (15, "\n\n\n"),
    (16, "émigré ÉTÉ naïve 語 текст ok"), (17, "aaaa " * 200), (18, "ab" * 400), (19, "x" * 199), (20, "y" * 200), (21, "z" * 201),
    (22, "one two three four five"), (23, "one two three four five six"), (-50, "negative id"), (0, "zero"),
]
CLASHING = ["n_words", "N_HIT", "items", "contaminated", "n_lines", "n_dropped", "lang_pred", "score", "bits", "rejected", "kept", "host"]


def frame(spark, rows=DOCS, clashing=()):
    """``rows`` over several partitions, with extra columns of the given names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in clashing)
    full = [(i, t, "en", "src0", len(t or ""), *["mine"] * len(clashing)) for i, t in rows]
    return spark.createDataFrame(full, schema).repartition(3)


def empty(spark, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame([], schema)
