"""Spark-vs-DuckDB comparison used by the tests (row count, column names, value multiset)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def canon(columns: list[str], rows: list[tuple]):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return cols, lines, h


def compare(spark_df, con, sql: str):
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = spark_df.columns
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sl, sh = canon(s_cols, s_rows)
    dc, dl, dh = canon(d_cols, d_rows)
    return {
        "rows": (len(sl), len(dl)),
        "cols_match": sc == dc,
        "cols": (sc, dc),
        "match": sc == dc and sh == dh,
        "diff": (sorted(set(sl) - set(dl))[:5], sorted(set(dl) - set(sl))[:5]),
    }
