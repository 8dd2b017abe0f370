"""Compare registered queries with their SQL: column names, types, row counts and values."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb

_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(0.0 if v == 0 else v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(rows, order):
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    names, found = rel.columns, []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    theirs = dict(zip(names, map(str, rel.types)))
    for name, kind in df.dtypes:
        if _TYPES.get(kind, kind) != theirs[name]:
            found.append(f"type of {name}: {kind} against {theirs[name]}")
    a = _rows([tuple(r) for r in df.collect()], [df.columns.index(n) for n in sorted(names)])
    b = _rows(rel.fetchall(), [names.index(n) for n in sorted(names)])
    if len(a) != len(b):
        found.append(f"{len(a)} rows against {len(b)}")
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        found.append(f"values: {str(only_a[:2])[:600]} against {str(only_b[:2])[:600]}")
    return found
