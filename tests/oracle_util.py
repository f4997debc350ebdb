"""Compare a Spark DataFrame with a DuckDB query over the same parquet tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

SF_SMALL = "/root/testdata/sf0.001"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_conn(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return [cols[i] for i in order], out


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    out = {
        "rows_spark": len(sr), "rows_oracle": len(dr),
        "cols_match": sc == dc, "spark_cols": sc, "oracle_cols": dc,
        "hash_match": sc == dc and digest(sr) == digest(dr),
    }
    if not out["hash_match"] and sc == dc:
        ds = set(sr) - set(dr)
        do = set(dr) - set(sr)
        out["only_spark"] = sorted(ds, key=repr)[:3]
        out["only_oracle"] = sorted(do, key=repr)[:3]
    out["ok"] = out["hash_match"] and len(sr) == len(dr)
    return out
