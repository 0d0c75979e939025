"""Compares a query with its SQL counterpart, row by row, whatever the order."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    return repr(float(f"{value:.9g}")) if isinstance(value, float) else repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows), [names[i] for i in order]


TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def types(con, sql, df):
    """Column types of both sides, by name."""
    described = con.execute(f"describe {sql}").fetchall()
    return dict(df.dtypes), {row[0]: TYPES.get(row[1], row[1]) for row in described}


def compare(con, sql, df):
    """None if equal, else a short description of the difference."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want, want_names = _rows(names, result.fetchall())
    got, got_names = _rows(df.columns, [tuple(r) for r in df.collect()])
    if want_names != got_names:
        return f"columns {got_names} instead of {want_names}"
    if want != got:
        extra, lost = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows instead of {len(want)}; extra {extra}, missing {lost}"
    return None
