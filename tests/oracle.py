"""Comparison of a query with its SQL in DuckDB, order aside."""

import os
from decimal import Decimal

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{name}") else "")
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path}'")
    return con


def same_rows(df, sql, sf_dir):
    result = connect(sf_dir).sql(sql)
    names = sorted(df.columns)
    assert names == sorted(result.columns)

    def plain(v):
        if isinstance(v, (bytearray, memoryview)):
            return bytes(v)
        return float(v) if isinstance(v, Decimal) else v

    at = [result.columns.index(n) for n in names]
    ours = sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())
    theirs = sorted(repr(tuple(plain(r[i]) for i in at)) for r in result.fetchall())
    assert ours == theirs
