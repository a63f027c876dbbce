"""Compares a Spark result with DuckDB on the same tables: names, types, values."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

INTEGERS = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT"}
OTHERS = {
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def duck_type(spark_type: str) -> str:
    return (INTEGERS | OTHERS).get(spark_type, spark_type.upper())


def assert_same(frame, connection, sql: str) -> int:
    expected = connection.execute(sql)
    columns = [(d[0], str(d[1])) for d in expected.description]
    assert sorted((n, duck_type(t)) for n, t in frame.dtypes) == sorted(columns)
    order = sorted(frame.columns)
    place = {name: i for i, (name, _) in enumerate(columns)}
    want = Counter(tuple(row[place[n]] for n in order) for row in expected.fetchall())
    got = Counter(tuple(row[n] for n in order) for row in frame.select(*order).collect())
    assert got == want, (list((got - want))[:3], list((want - got))[:3])
    return sum(got.values())
