"""Compare a Spark query with its DuckDB oracle (row count, columns, value multiset)."""

from __future__ import annotations

import datetime as dt
import math

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


def duckdb_rows(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(sql)
    cols = rel.columns
    return cols, rel.fetchall()


def compare(df, sql: str, sf_dir: str) -> dict:
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    d_cols, d_rows = duckdb_rows(sql, sf_dir)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sn = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    dn = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    out["match"] = sn == dn
    if not out["match"]:
        sset, dset = set(sn), set(dn)
        out["only_spark"] = [dict(zip(order, r)) for r in list(sset - dset)[:3]]
        out["only_oracle"] = [dict(zip(order, r)) for r in list(dset - sset)[:3]]
    return out
