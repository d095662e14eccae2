"""Side-by-side check of a Spark query against its DuckDB statement."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def digest(cols: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    sn, sh = digest(s_cols, s_rows)
    dn, dh = digest(d_cols, d_rows)
    res = {"rows_spark": sn, "rows_oracle": dn, "schema": sorted(s_cols) == sorted(d_cols),
           "values": sh == dh}
    if not res["values"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        a = {repr(tuple(_norm(r[i]) for i in order_s)) for r in s_rows}
        b = {repr(tuple(_norm(r[i]) for i in order_d)) for r in d_rows}
        res["only_spark"] = sorted(a - b)[:3]
        res["only_oracle"] = sorted(b - a)[:3]
        res["cols"] = sorted(s_cols)
        if sorted(s_cols) != sorted(d_cols):
            res["cols_oracle"] = sorted(d_cols)
    return res
