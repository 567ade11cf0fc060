"""Run a registered query and its SQL counterpart and compare the rows as multisets."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, Decimal):
        return float(value) if value != value.to_integral() else int(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return "D" + value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, connection, sql: str) -> tuple[int, str]:
    """(row count, problem); an empty problem means both sides agree."""
    cursor = connection.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    expected = _rows(expected_names, cursor.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    n = sum(actual.values())
    if sorted(expected_names) != sorted(df.columns):
        return n, f"columns {sorted(df.columns)} != {sorted(expected_names)}"
    if actual != expected:
        only_a, only_e = list((actual - expected).items())[:3], list((expected - actual).items())[:3]
        return n, f"rows {n} != {sum(expected.values())}; only spark {only_a}; only sql {only_e}"
    return n, ""
