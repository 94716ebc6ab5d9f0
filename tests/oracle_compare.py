"""Order-insensitive comparison of a Spark result with DuckDB SQL."""

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "events"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows), sorted(columns)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def assert_matches(df, sql, con):
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    assert got[1] == want[1], (got[1], want[1])
    assert len(got[0]) == len(want[0])
    assert got[0] == want[0]
