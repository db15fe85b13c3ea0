"""Runs a registered query and its SQL, and compares the two results value by value."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
            )
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def difference(frame, connection, sql: str) -> str | None:
    """None if equal, else a description: columns, types, or rows with their counts."""
    expected = connection.execute(sql).to_arrow_table()
    actual = frame.toArrow()
    names = sorted(expected.column_names)
    if sorted(actual.column_names) != names:
        return f"columns {sorted(actual.column_names)} != {names}"
    types = [
        (n, str(actual.schema.field(n).type), str(expected.schema.field(n).type))
        for n in names
        if str(actual.schema.field(n).type).replace("large_", "")
        != str(expected.schema.field(n).type)
        and not str(expected.schema.field(n).type).startswith("timestamp")
    ]
    if types:
        return f"types {types}"
    left, right = (
        Counter(
            tuple(plain(v) for v in row)
            for row in zip(*(t.column(n).to_pylist() for n in names), strict=True)
        )
        for t in (actual, expected)
    )
    if left != right:
        return (
            f"rows {sum(left.values())} != {sum(right.values())}; "
            f"only here {list((left - right).items())[:3]}; "
            f"only in SQL {list((right - left).items())[:3]}"
        )
    return None
