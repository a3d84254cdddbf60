"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from contactflow.plans.fixtures import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6f}".rstrip("0").rstrip(".")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return sorted(tuple(cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def differences(spark_df, con, sql: str) -> str | None:
    got, got_cols = rows_of(spark_df.columns, spark_df.collect())
    res = con.execute(sql)
    want, want_cols = rows_of([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        extra = sorted(set(got) ^ set(want))[:3]
        return f"rows {len(got)} != {len(want)}: {extra}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{a} != {b}"
    return None
