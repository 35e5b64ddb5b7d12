"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb

TABLES = ["customer", "lineitem", "nation", "orders"]

TYPE_NAMES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((v is not None, v) if v is not None else (False, 0) for v in row),
    )


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: TYPE_NAMES[str(d[1])] for d in cursor.description}
    expected = sorted_rows(columns, cursor.fetchall())
    actual = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    assert dict(df.dtypes) == types
    assert len(actual) == len(expected)
    for mine, theirs in zip(actual, expected):
        assert mine == theirs
    return len(actual)
