"""Compare a query with its oracle over the same tables."""

from __future__ import annotations

import decimal
import math
import os

import duckdb
from quillbank.plans.fixtures import RAW

SF = "/root/testdata/sf0.001"


def connect(sf_dir: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def same(spark, con, query, sql: str, sf_dir: str = SF) -> None:
    got = query(spark, sf_dir)
    c = con.execute(sql)
    names = [d[0] for d in c.description]
    assert sorted(names) == sorted(got.columns)
    at = [names.index(x) for x in got.columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in c.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in r) for r in got.collect()), key=repr) == want
