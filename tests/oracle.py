"""Compares a query with its SQL on the driver's tables."""

import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{folder}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(plain(r[i]) for i in at)) for r in rows)


def same(spark, query, sql, folder):
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    r = connect(folder).execute(sql)
    want = rows_of([x[0] for x in r.description], r.fetchall())
    assert got == want
