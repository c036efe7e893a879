"""Compares a query with its SQL on DuckDB, free of row order."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for f in glob.glob(folder + "/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, list):
        return tuple(map(plain, v))
    return str(v) if hasattr(v, "isoformat") else v


def rows(data):
    return sorted((tuple(map(plain, r)) for r in data), key=lambda t: tuple((v is None, str(type(v)), str(v)) for v in t))


def compare(spark, con, folder, query, sql):
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = rows(tuple(r) for r in df.select(*columns).collect())
    want = rows(con.execute(f"select {', '.join(columns)} from ({sql})").fetchall())
    assert got == want
