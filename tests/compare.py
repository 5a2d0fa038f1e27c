"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    return rows_of(rel.columns, rel.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} <> {dc}"
    if sr == dr:
        return None
    only_s, only_d = set(sr) - set(dr), set(dr) - set(sr)
    return f"{len(sr)} <> {len(dr)} rows; only spark {sorted(only_s, key=str)[:3]}; only sql {sorted(only_d, key=str)[:3]}"
