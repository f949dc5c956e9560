"""Comparison of a Spark result with DuckDB over the same sample files."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value: object) -> object:
    if isinstance(value, bool) or value is None or isinstance(value, (int, str, float)):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        raise AssertionError("dates and times leave the catalog as text")
    raise AssertionError(f"unexpected value type {type(value)}")


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    """Rows as a multiset, columns in name order, so duplicates count and order does not."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(_plain(row[i])).__name__, _plain(row[i])) for i in order) for row in rows)


def differences(spark_df, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = db.execute(sql)
    columns = [column[0] for column in cursor.description]
    expected = rows_of(columns, cursor.fetchall())
    actual = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    problems = []
    if sorted(columns) != sorted(spark_df.columns):
        problems.append(f"columns {sorted(spark_df.columns)} != {sorted(columns)}")
    if sum(actual.values()) != sum(expected.values()):
        problems.append(f"rows {sum(actual.values())} != {sum(expected.values())}")
    missing, extra = expected - actual, actual - expected
    if missing or extra:
        problems.append(f"missing {list(missing.items())[:3]} extra {list(extra.items())[:3]}")
    return problems
