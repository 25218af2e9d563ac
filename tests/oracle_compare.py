"""Order-insensitive comparison of a Spark result with a DuckDB result (names, rows, values)."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        t = pd.Timestamp(v)
        return (t.tz_localize(None) if t.tzinfo else t).isoformat()
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    return repr(v)


def rows(pdf: pd.DataFrame) -> Counter:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    return Counter(tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None))


def assert_same(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> None:
    assert sorted(spark_pdf.columns) == sorted(oracle_pdf.columns)
    assert len(spark_pdf) == len(oracle_pdf)
    a, b = rows(spark_pdf), rows(oracle_pdf)
    assert a == b, f"only spark: {list((a - b).elements())[:3]} only oracle: {list((b - a).elements())[:3]}"
