"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t)
    )


def difference(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    df = fn(spark, sf_dir)
    mine = df.collect()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    for x, y in zip(a, b):
        if x != y:
            return f"{x} != {y}"
    return None
