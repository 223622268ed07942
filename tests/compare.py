"""Run a query and its SQL answer and compare them."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')"
        )
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value + 0.0, 5) + 0.0
    if hasattr(value, "as_tuple"):
        return round(float(value), 5)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return rows_of(columns, cur.fetchall())
