"""Compares a query with its SQL over the same tables."""

import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}"
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return int(v) if isinstance(v, float) and v.is_integer() else round(v, 6) if isinstance(v, float) else v


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(([_plain(v) for v in r] for r in frame.itertuples(index=False)), key=str)


def assert_same(df, con, sql):
    got, want = df.toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
