"""Runs registered queries and their SQL on the same tables and compares rows without regard to order."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v).removesuffix(".000000")
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    return round(float(v), 6) if not isinstance(v, int) else v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in values], key=repr), sorted(names)


def differ(spark, con, sf_dir, query, sql):
    """None if both give the same rows, else a description."""
    df = query(spark, sf_dir)
    got, names = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want, want_names = rows([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} against {want_names}"
    if got != want:
        odd = [(a, b) for a, b in zip(got, want, strict=False) if a != b][:3]
        return f"{len(got)} rows against {len(want)}; first differences {odd}"
    return None
