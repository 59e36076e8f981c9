"""Compare a registered query with its SQL twin on the given tables."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, connection, name, query, sql, sf_dir) -> str | None:
    """None if both sides have the same columns and rows, else what differs first."""
    df = query(spark, sf_dir)
    columns, rows = _sorted_rows(df.columns, df.collect())
    result = connection.execute(sql)
    their_columns, their_rows = _sorted_rows([d[0] for d in result.description], result.fetchall())
    if columns != their_columns:
        return f"{name}: columns {columns} and {their_columns}"
    if len(rows) != len(their_rows):
        return f"{name}: {len(rows)} rows and {len(their_rows)}"
    for row, other in zip(rows, their_rows):
        if row != other:
            return f"{name}: {row!r:.600} and {other!r:.600}"
        if [type(v) for v in row] != [type(v) for v in other]:
            return f"{name}: types of {row!r:.300} and {other!r:.300}"
    return None
