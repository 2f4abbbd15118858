"""Order-free comparison of a Spark result with its DuckDB oracle."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return "NULL" if v is None else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    """Return None when equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return None
    extra, missing = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
    return f"rows {len(got)} vs {len(want)}; only Spark {extra}; only oracle {missing}"
