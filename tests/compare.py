"""Row-by-row comparison of a Spark result with SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return repr(value)


def rows_by_name(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(result, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both have the same columns and the same rows, to the last bit."""
    relation = connection.execute(sql)
    sql_names = [column[0] for column in relation.description]
    if sorted(result.columns) != sorted(sql_names):
        return f"columns {sorted(result.columns)} and {sorted(sql_names)}"
    sql_types = {column[0]: str(column[1]) for column in relation.description}
    types = {name: TYPES[kind] for name, kind in result.dtypes}
    if types != sql_types:
        return f"types differ: {set(types.items()) ^ set(sql_types.items())}"
    expected = rows_by_name(sql_names, relation.fetchall())
    found = rows_by_name(result.columns, [tuple(row) for row in result.collect()])
    if expected == found:
        return None
    missing, extra = expected - found, found - expected
    return (
        f"{sum(found.values())} rows, {sum(expected.values())} expected; "
        f"missing {list(missing.items())[:2]}; extra {list(extra.items())[:2]}"
    )
