"""Runs a query and its SQL twin and compares rows, whatever their order."""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def compare(frame: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Assert equal names and rows; give the number of rows."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    want = _rows(names, result.fetchall())
    got = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    assert sorted(frame.columns) == sorted(names), (frame.columns, names)
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        assert a == b, f"\n got {a}\nwant {b}"
    return len(got)
