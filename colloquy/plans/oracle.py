"""Side-by-side check of a registered query against its DuckDB oracle.

Order-insensitive: rows are rendered with columns sorted by name, sorted, and
hashed; floats are rounded to 9 places. Used by the check script and tests.
"""

from __future__ import annotations

import hashlib
import math
import os

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{_norm(k)}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, bool):
        return str(v).lower()
    return "" if v is None else str(v) if not isinstance(v, int) else str(int(v))


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode("utf-8", "surrogatepass"))
        h.update(b"\n")
    return h.hexdigest()[:16]


def first_diff(columns_a, rows_a, columns_b, rows_b, limit=3):
    oa = sorted(range(len(columns_a)), key=lambda i: columns_a[i])
    ob = sorted(range(len(columns_b)), key=lambda i: columns_b[i])
    sa = {"\x1f".join(_norm(r[i]) for i in oa) for r in rows_a}
    sb = {"\x1f".join(_norm(r[i]) for i in ob) for r in rows_b}
    return [x[:300] for x in sorted(sa - sb)[:limit]], [x[:300] for x in sorted(sb - sa)[:limit]]




def duckdb_with_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    df = query(spark, sf_dir)
    cols_s = df.columns
    rows_s = [tuple(r) for r in df.collect()]
    out = {"name": name, "spark_rows": len(rows_s)}
    if sql is None:
        out["ok"] = None
        return out
    cur = con.execute(sql)
    cols_d = [d[0] for d in cur.description]
    rows_d = cur.fetchall()
    out.update(
        duck_rows=len(rows_d),
        cols_match=sorted(cols_s) == sorted(cols_d),
        hash_match=digest(cols_s, rows_s) == digest(cols_d, rows_d),
    )
    out["ok"] = out["cols_match"] and out["hash_match"] and len(rows_s) == len(rows_d)
    if not out["ok"] and out["cols_match"]:
        out["only_spark"], out["only_duck"] = first_diff(cols_s, rows_s, cols_d, rows_d)
    elif not out["ok"]:
        out["spark_cols"], out["duck_cols"] = cols_s, cols_d
    return out
