"""Compare a Spark result with DuckDB on the same parquet tables."""

from __future__ import annotations

import math
import os
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return "NULL" if v is None else str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(_plain(r[k]) for k in order) for r in rows)


def diff(spark_df, con, sql, n=5):
    """None when equal, else a short text."""
    a_cols, a = canonical(spark_df.columns, spark_df.collect())
    cur = con.execute(sql)
    b_cols, b = canonical([c[0] for c in cur.description], cur.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} != {b_cols}"
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:n], sorted(set(b) - set(a))[:n]
    return f"rows {len(a)} vs {len(b)}; only spark {only_a}; only sql {only_b}"
