"""Row-by-row comparison of a Spark result with SQL over the same tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
            )
    return connection


def differences(rows, sql: str, connection) -> tuple[int, int, list, list]:
    """Row counts of both sides and samples of rows only one side has."""
    names = sorted(rows.columns)
    result = connection.execute(sql)
    theirs = [column[0] for column in result.description]
    assert sorted(theirs) == names, (names, sorted(theirs))
    order = [theirs.index(name) for name in names]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    actual = Counter(tuple(row[name] for name in names) for row in rows.select(*names).collect())
    return (
        sum(actual.values()),
        sum(expected.values()),
        list((actual - expected).items())[:2],
        list((expected - actual).items())[:2],
    )
