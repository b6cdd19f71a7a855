"""Compare a Spark result with the oracle's rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def compare(df, connection, sql: str) -> tuple[int, int, Counter, Counter]:
    """Row counts of both sides, and the rows that only one side has. Values must be equal."""
    result = connection.sql(sql)
    names = sorted(df.columns)
    assert names == sorted(result.columns), (names, sorted(result.columns))
    ours = Counter(tuple(row[name] for name in names) for row in df.collect())
    order = [result.columns.index(name) for name in names]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return sum(ours.values()), sum(theirs.values()), ours - theirs, theirs - ours
