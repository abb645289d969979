"""Run a registered query in Spark and its oracle in DuckDB; compare rows exactly."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

from ..sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name: str, sf_dir: str, query_fn, sql: str, con=None) -> dict:
    sdf = query_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_oracle"] = [r for r in b if r not in sa][:3]
        out["cols"] = sorted(s_cols)
    return out
