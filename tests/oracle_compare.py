"""Run registered Spark queries and their DuckDB twins; compare results."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return None
        return round(float(v), 9)
    if isinstance(v, (pd.Timestamp, dt.date)):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    spdf = sdf.toPandas() if sdf.columns else pd.DataFrame()
    ddf = con.execute(sql).fetchdf()
    d_cols = sorted(ddf.columns)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    a, b = rows(spdf), rows(ddf)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(a)} rows"
