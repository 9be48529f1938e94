"""Runs catalogue queries and their SQL twins side by side and compares names, types and every value."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

DUCK_TYPES = {
    T.StringType: "VARCHAR",
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.DoubleType: "DOUBLE",
    T.FloatType: "FLOAT",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {r[0]: r[1] for r in described}
    names = sorted(types)
    problems = []
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    for f in df.schema.fields:
        if DUCK_TYPES.get(type(f.dataType)) != types[f.name]:
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} vs {types[f.name]}")
    order = [[r[0] for r in described].index(n) for n in names]
    left = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    right = sorted((tuple(r[i] for i in order) for r in con.execute(sql).fetchall()), key=_key)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if not _same(a, b)]
    if bad:
        problems.append(f"{len(bad)} differing rows, first {bad[0]}")
    return problems


def _same(a: tuple, b: tuple) -> bool:
    return all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
        for x, y in zip(a, b)
    )
