"""Spark query against its DuckDB twin: same columns, same rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def norm(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


TYPE_NAMES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "INTEGER"}


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    types = {c: str(t) for c, t in zip(rel.columns, rel.types, strict=True)}
    for field in df.schema.fields:
        expected = TYPE_NAMES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types[field.name] != expected:
            return f"type of {field.name}: {expected} != {types[field.name]}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"first difference: spark {a} duckdb {b}"
    return None
