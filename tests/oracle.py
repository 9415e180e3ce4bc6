"""Comparison of a registered query with its DuckDB equivalent, on the smallest tables."""

import os

import duckdb

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
PRESENT = os.path.isdir(DATA)


def plain(v):
    if v is None or isinstance(v, bool):
        return repr(v)
    if isinstance(v, (int, float)):
        return f"{v:.9g}"
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return repr({k: plain(x) for k, x in v.items()})
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def agree(spark, query, sql):
    df = query(spark, DATA)
    names = sorted(df.columns)
    got = sorted([plain(r[c]) for c in names] for r in df.select(*names).collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = con.execute(sql)
    have = [d[0] for d in found.description]
    assert sorted(have) == names
    at = [have.index(c) for c in names]
    want = sorted([plain(r[i]) for i in at] for r in found.fetchall())
    assert got == want
    assert got, "both sides are empty: nothing was compared"
    return len(got)
