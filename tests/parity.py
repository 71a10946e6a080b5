"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v == int(v):
        return int(v)
    return v.item() if hasattr(v, "item") else v


def rows(df: pd.DataFrame) -> Counter:
    df = df[sorted(df.columns)]
    return Counter(tuple(_value(v) for v in r) for r in df.itertuples(index=False))


def assert_same(spark, con, query, sql: str, sf_dir: str) -> None:
    got, want = query(spark, sf_dir).toPandas(), con.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
