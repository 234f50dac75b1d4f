"""Rows of a DataFrame and of DuckDB, made comparable."""

from decimal import Decimal
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"


def connect(folder: str = SMALL):
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str(tuple(_plain(r[i]) for i in order)) for r in values)


def same(df, con, sql: str) -> None:
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, found.fetchall())
