"""Local stand-in for the driver's correctness check: Spark query vs DuckDB SQL."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return v


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    data = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, data


def compare(spark, sf_dir: str, query, sql: str):
    df = query(spark, sf_dir)
    s_cols, s_rows = normalized(df.columns, [tuple(r) for r in df.collect()])
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_cols, d_rows = normalized(d_cols, res.fetchall())
    return (s_cols, s_rows), (d_cols, d_rows)
