"""Compare a Spark result with DuckDB SQL the way the driver does: same column
names, same row count, same multiset of rows (order-insensitive)."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return int(v)
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return float(f"{float(v):.9g}")
    except Exception:
        pass
    return v


def compare(sdf, con, sql: str) -> tuple[bool, str]:
    s_cols = sdf.columns
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order = sorted(s_cols)
    s_idx = [s_cols.index(c) for c in order]
    d_idx = [d_cols.index(c) for c in order]
    s_rows = [tuple(_norm(r[i]) for i in s_idx) for r in sdf.collect()]
    d_rows = [tuple(_norm(r[i]) for i in d_idx) for r in d_rows]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ; spark-only {only_s} duck-only {only_d} (cols {order})"
    return True, f"{len(s_rows)} rows"
