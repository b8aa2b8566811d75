"""Side-by-side comparison of a query with its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return value


def table(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns sorted by name, rows as sorted plain values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def spark_table(df):
    return table(df.columns, df.collect())


def sql_table(con, sql: str):
    cursor = con.execute(sql)
    return table([c[0] for c in cursor.description], cursor.fetchall())


def difference(left, right) -> str | None:
    """First difference between two tables, or None."""
    if left[0] != right[0]:
        return f"columns {left[0]} and {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} and {len(right[1])} rows"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{a} and {b}"
    return None
