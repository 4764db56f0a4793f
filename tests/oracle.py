"""Runs a query and its SQL over one folder and compares them as sorted rows."""

import os
from pathlib import Path

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def cell(x):
    if hasattr(x, "item"):
        x = x.item()
    if x is None or x != x:
        return None
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)):
        return f"{x:.6f}"
    return str(x)


def rows(columns, table):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in table), key=str)


def connect(folder=FOLDER):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def same(spark, con, query, sql, folder=FOLDER):
    df = query(spark, folder)
    got = rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows(names, result.fetchall())
