"""Comparing a query's rows with those of its SQL."""

from __future__ import annotations

import math
import numbers
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        files = path if path.is_file() else f"{path}/*.parquet"
        connection.execute(f"create view {path.stem} as select * from '{files}'")
    return connection


def _plain(value):
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, numbers.Number) and not isinstance(value, bool):
        return round(float(value), 6)
    return value


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)].astype(object)
    return sorted(repr(tuple(map(_plain, row))) for row in df.itertuples(index=False, name=None))
