"""Run Spark plans and DuckDB oracle SQL on the same Parquet tables and compare results."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pandas as pd

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows_of(records: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    cols = df.columns
    return cols, rows_of([tuple(r) for r in df.collect()], cols)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    return cols, rows_of(rel.fetchall(), cols)


def compare(df, con, sql: str) -> tuple[bool, str]:
    scols, srows = spark_rows(df)
    dcols, drows = duck_rows(con, sql)
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row count differs: spark={len(srows)} duck={len(drows)}"
    if srows != drows:
        diff = [(a, b) for a, b in zip(srows, drows) if a != b][:3]
        return False, f"values differ (first): {diff}"
    return True, f"{len(srows)} rows"
