"""Cross-engine comparison: a registered Spark query against its DuckDB oracle,
row count + schema (column names) + order-insensitive value hash."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return names, lines


def compare(spark_df, con, sql: str):
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = spark_df.columns
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    sn, sl = canon(s_cols, s_rows)
    dn, dl = canon(d_cols, d_rows)
    res = {"rows_spark": len(sl), "rows_oracle": len(dl), "schema": sn == dn,
           "hash": hashlib.sha1("\n".join(sl).encode()).hexdigest() ==
           hashlib.sha1("\n".join(dl).encode()).hexdigest()}
    if not res["hash"]:
        diff_s = sorted(set(sl) - set(dl))[:3]
        diff_d = sorted(set(dl) - set(sl))[:3]
        res["detail"] = {"cols_spark": sn, "cols_oracle": dn, "only_spark": diff_s, "only_oracle": diff_d}
    res["ok"] = res["schema"] and res["hash"] and res["rows_spark"] == res["rows_oracle"]
    return res
