"""Runs a query and its DuckDB twin on the same tables and compares rows whatever their order."""

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _cell(x):
    if isinstance(x, np.ndarray):
        return tuple(_cell(y) for y in x.tolist())
    if isinstance(x, list | tuple):
        return tuple(_cell(y) for y in x)
    if x is None or x is pd.NA or x != x:
        return None
    if isinstance(x, np.generic):
        x = x.item()
    return x


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(_cell(x) for x in r) for r in df.astype(object).itertuples(index=False)), key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(spark, sf_dir, query, sql):
    """(columns of one side only, rows of either side only)."""
    ours, theirs = query(spark, sf_dir).toPandas(), duck(sf_dir).execute(sql).df()
    if set(ours.columns) != set(theirs.columns):
        return sorted(set(ours.columns) ^ set(theirs.columns)), []
    a, b = rows(ours), rows(theirs)
    return [], [] if a == b else [x for x in a if x not in set(b)][:3] + [x for x in b if x not in set(a)][:3] or [len(a), len(b)]
