"""Run registered queries and their oracle SQL side by side."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (int, datetime.date)):
        return v if not isinstance(v, int) else float(v)
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    return float(v) if v.__class__.__name__ == "Decimal" else v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([repr(tuple(canon(r[i]) for i in order)) for r in data])


def compare(df, con, sql):
    """None when equal, else a short text that says how they differ."""
    res = con.execute(sql)
    names = [x[0] for x in res.description]
    want = res.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows(df.columns, got), rows(names, want)
    if a == b:
        return None
    sa, sb = set(a), set(b)
    extra = [x for x in a if x not in sb][:3]
    missing = [x for x in b if x not in sa][:3]
    return f"rows {len(a)} vs {len(b)}; only here {extra}; only oracle {missing}"
