"""Runs registered queries next to their SQL and compares every row."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp": "TIMESTAMP", "float": "FLOAT",
    "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN", "binary": "BLOB",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    found = con.sql(sql)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_types = {c: str(t) for c, t in zip(found.columns, found.types)}
    problems = []
    if spark_types != duck_types:
        problems.append(f"schema {set(spark_types.items()) ^ set(duck_types.items())}")
        if set(spark_types) != set(duck_types):
            return problems
    ours, theirs = _rows(df.columns, df.collect()), _rows(found.columns, found.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows, expected {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    if not theirs:
        problems.append("no rows to compare")
    return problems
