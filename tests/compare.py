"""Runs a query in Spark and its SQL in DuckDB and compares the rows exactly."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """Empty if column names and rows (as a multiset) are the same."""
    names = sorted(df.columns)
    result = con.execute(sql)
    got_names = [d[0] for d in result.description]
    if sorted(got_names) != names:
        return [f"columns {names} != {sorted(got_names)}"]
    order = [got_names.index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    actual = Counter(tuple(row) for row in df.select(*names).collect())
    if actual == expected:
        return []
    return [
        f"{sum(actual.values())} rows in Spark, {sum(expected.values())} expected; columns {names}",
        *[f"only in Spark: {r}" for r in list((actual - expected))[:3]],
        *[f"only expected: {r}" for r in list((expected - actual))[:3]],
    ]
