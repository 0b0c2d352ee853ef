"""Order-insensitive comparison of a Spark result with a DuckDB oracle.

Used by the tests to mirror the driver's correctness gate: same row count,
same column names, same multiset of rows (floats compared after rounding).
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(
            f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, digits)
        return 0.0 if r == 0 else r
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item(), digits)
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def normalise(df: pd.DataFrame, digits: int = 6) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v, digits) for v in row)
            for row in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                            for x in r))


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame, digits: int = 6) -> str | None:
    """Return None when equal, else a short description of the difference."""
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(oracle_pdf.columns)}"
    if len(spark_pdf) != len(oracle_pdf):
        return f"row count differs: {len(spark_pdf)} vs {len(oracle_pdf)}"
    a, b = normalise(spark_pdf, digits), normalise(oracle_pdf, digits)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return None
