"""Compares a query with its DuckDB twin."""

import glob
import os

import duckdb
import numpy as np


def duck(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        inner = p if os.path.isfile(p) else f"{p}/*.parquet"
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{inner}')")
    return con


def _plain(x):
    if x is None or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, (float, np.floating)):
        return float(f"{x:.9g}")
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def assert_same(df, sql, sf_dir):
    con = duck(sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want, got = rows_of(names, cur.fetchall()), rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(want) == len(got), (len(got), len(want))
    for g, w in zip(got, want, strict=True):
        assert g == w, (g, w)
