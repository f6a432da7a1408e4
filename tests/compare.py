"""Run a registered query and its SQL oracle on the same tables and compare."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            source = f"{path}/*.parquet" if path.is_dir() else path
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    made = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(made, key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    return sorted(names), _rows(names, found.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else what differs first."""
    names, got = spark_rows(df)
    expected_names, expected = oracle_rows(con, sql)
    if names != expected_names:
        return f"columns {set(names) ^ set(expected_names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return f"row differs in {cells[:5]}"
    types = {n: type(x).__name__ for row in got for n, x in zip(names, row) if x is not None}
    expected_types = {n: type(x).__name__ for row in expected for n, x in zip(names, row) if x is not None}
    if types != expected_types:
        return f"types {[(n, types[n], expected_types[n]) for n in types if types[n] != expected_types[n]]}"
    return None
