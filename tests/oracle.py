"""Compare a query with its SQL twin on the same parquet tables."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{directory}/{table}.parquet')")
    return connection


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(row[i]).__name__, row[i]) for i in order) for row in rows)


def compare(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Fail where columns, value types or values differ; return the number of rows."""
    result = connection.execute(sql)
    expected_names = [d[0] for d in result.description]
    expected = result.fetchall()
    names = frame.columns
    actual = [tuple(r) for r in frame.collect()]
    assert sorted(names) == sorted(expected_names), (sorted(names), sorted(expected_names))
    assert len(actual) == len(expected), f"{len(actual)} rows, SQL has {len(expected)}"
    got, wanted = _rows(names, actual), _rows(expected_names, expected)
    assert got == wanted, f"only here: {list((got - wanted).items())[:3]}; only in SQL: {list((wanted - got).items())[:3]}"
    return len(actual)


def integer_widths(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> dict[str, tuple[str, str]]:
    """Columns whose type differs between the two engines."""
    same = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "string": "VARCHAR",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "float": "FLOAT",
    }
    described = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return {
        f.name: (f.dataType.simpleString(), described[f.name])
        for f in frame.schema
        if same.get(f.dataType.simpleString()) != described[f.name]
    }
