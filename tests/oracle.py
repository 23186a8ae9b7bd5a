"""Compare a Spark result with DuckDB's answer on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return repr(value) if value is not None else "~"


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted(tuple(_cell(row[i]) for i in order) for row in rows),
    )


def duck(con, sql: str):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])
