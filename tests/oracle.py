"""Running a query and its SQL side by side."""

import datetime
import decimal
import math
import os
from collections import Counter

import duckdb


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def connect(folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}'")
    return con


def assert_same(df, con, sql):
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    a, b = [df.columns.index(c) for c in sorted(names)], [names.index(c) for c in sorted(names)]
    left = Counter(tuple(plain(r[i]) for i in a) for r in df.collect())
    right = Counter(tuple(plain(r[i]) for i in b) for r in got.fetchall())
    assert left == right
