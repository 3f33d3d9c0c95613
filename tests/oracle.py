"""Compare a query with its SQL on DuckDB, row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return ("n", float(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("null",) if isinstance(v, float) and math.isnan(v) else ("n", float(v))
    if isinstance(v, dt.datetime) and v.time() == dt.time(0):
        return ("d", v.date().isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, list):
        return ("l", tuple(plain(x) for x in v))
    return ("null",) if v is None else ("s", str(v))


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return normalised(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return normalised([d[0] for d in cur.description], cur.fetchall())


def difference(df, con, sql) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    (c1, r1), (c2, r2) = spark_rows(df), sql_rows(con, sql)
    if c1 != c2:
        return f"columns {c1} != {c2}"
    if len(r1) != len(r2):
        return f"rows {len(r1)} != {len(r2)}"
    for a, b in zip(r1, r2, strict=True):
        if a != b:
            return f"spark {a}\n  sql {b}"
    return None
