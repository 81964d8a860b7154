"""Comparison of a query with its SQL in DuckDB."""

import os

import duckdb
import numpy as np
import pandas as pd


def views(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def text(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
            return "NULL"
        if isinstance(x, (int, float, np.integer, np.floating)) and not isinstance(x, (bool, np.bool_)):
            return f"{float(x):.9g}"
        return str(x)[:10] if hasattr(x, "year") else str(x)

    return sorted(tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False))
