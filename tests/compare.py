"""Query rows against the rows of the same name's SQL."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def cell(v):
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
        return "null"
    return str(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(df):
    df = df[sorted(df.columns)].map(cell)
    return list(df.columns), sorted(map(tuple, df.to_numpy().tolist()))


def same(got, want):
    assert rows(got) == rows(want)
