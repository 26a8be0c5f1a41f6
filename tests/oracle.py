"""Compares a query's rows with its SQL in DuckDB."""

import math
import os

import duckdb
import pandas as pd


def connection(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def _plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, float):
        return repr(round(x, 9) + 0.0)
    return str(pd.Timestamp(x)) if hasattr(x, "isoformat") else str(x)


def rows(df):
    return sorted(tuple(map(_plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


def assert_same(spark, query, sql, sf_dir):
    ours, theirs = query(spark, sf_dir).toPandas(), connection(sf_dir).execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
