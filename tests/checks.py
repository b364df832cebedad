"""Comparison of Spark and DuckDB results, and plan texts."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _text(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def normal(rows):
    return sorted(tuple(_text(v) for v in row) for row in rows)


def compare(frame, connection, sql):
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    columns = sorted(frame.columns)
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in frame.dtypes} == kinds
    order = [names.index(c) for c in columns]
    expected = normal([tuple(r[i] for i in order) for r in result.fetchall()])
    assert normal(frame.select(*columns).collect()) == expected
    return len(expected)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()
