"""Compares a query with its oracle statement: columns, row counts and values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_views(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return str(value)


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> list[str]:
    cursor = connection.execute(sql)
    oracle_names = [column[0] for column in cursor.description]
    if sorted(oracle_names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} and {sorted(oracle_names)}"]
    expected = _bag(oracle_names, cursor.fetchall())
    actual = _bag(frame.columns, [tuple(row) for row in frame.collect()])
    missing, extra = expected - actual, actual - expected
    if not missing and not extra:
        return []
    return [
        f"rows {sum(actual.values())} and {sum(expected.values())}",
        f"missing {sum(missing.values())}: {list(missing)[:3]}",
        f"extra {sum(extra.values())}: {list(extra)[:3]}",
    ]
