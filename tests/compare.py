"""Run a registered query and its check SQL, and describe any difference."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if value is None:
        return ""
    return str(value)


FAMILY = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def _family(dtype: str) -> str:
    return FAMILY.get(dtype, dtype.upper())


def difference(df, con, sql: str) -> str | None:
    """None when rows, names and types agree, else a short description."""
    names = sorted(df.columns)
    ours = [tuple(r[n] for n in names) for r in df.collect()]
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} vs {sorted(rel.columns)}"
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    mine = {n: _family(t) for n, t in df.dtypes}
    bad = {n: (mine[n], types[n]) for n in names if mine[n].replace(" ", "") != types[n].replace(" ", "")}
    if bad:
        return f"types {bad}"
    order = [rel.columns.index(n) for n in names]
    theirs = [tuple(r[i] for i in order) for r in rel.fetchall()]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    a = sorted(tuple(map(_norm, r)) for r in ours)
    b = sorted(tuple(map(_norm, r)) for r in theirs)
    for x, y in zip(a, b):
        if x != y:
            return f"rows {names}\n  spark {x}\n  duckdb {y}"
    return None
