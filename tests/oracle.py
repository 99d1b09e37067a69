"""Runs a registered query and its SQL statement side by side and compares whole results."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATA = os.environ.get("BARLOOM_DATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    return v if v is None else str(v)


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """Differences as texts, empty when both sides agree."""
    t0 = time.time()
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    left = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    right_raw = rel.fetchall()
    if sorted(names) != cols:
        return [f"columns {cols} vs {sorted(names)}"]
    at = [names.index(c) for c in cols]
    right = [tuple(_norm(r[k]) for k in at) for r in right_raw]
    compare.seconds = (t1 - t0, time.time() - t1)
    compare.rows = len(left)
    if len(left) != len(right):
        return [f"{len(left)} rows vs {len(right)}"]
    out = []
    for a, b in zip(sorted(left, key=_key), sorted(right, key=_key)):
        for c, x, y in zip(cols, a, b):
            if x != y:
                out.append(f"{c}: {x!r} vs {y!r} in {a[:3]} / {b[:3]}")
    return out[:20]
