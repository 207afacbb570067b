"""Compare a Spark result with its DuckDB oracle, row for row."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (bool, int, str, dt.date, dt.datetime, Decimal)) or value is None:
        return value
    return str(value)


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, Counter(tuple(_plain(v) for v in row) for row in rows)


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cursor.fetchall()
    return [columns[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )
