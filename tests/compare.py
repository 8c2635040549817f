"""Order-insensitive comparison of a query with its SQL."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows), key=repr
    )


def spark_rows(df):
    return normalise(df.columns, df.collect())


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    return normalise([c[0] for c in cur.description], cur.fetchall())
