"""Compare a Spark result with DuckDB's for the same tables."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def differences(frame, connection, sql: str) -> list[str]:
    """Names, types and rows that differ; empty when the results are equal."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: KINDS.get(str(c[1]), str(c[1])) for c in result.description}
    expected = result.fetchall()
    found = []
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} instead of {sorted(columns)}"]
    for name, kind in frame.dtypes:
        if kinds[name] != kind:
            found.append(f"type of {name}: {kind} instead of {kinds[name]}")
    left, right = _bag(frame.columns, frame.collect()), _bag(columns, expected)
    if left != right:
        found.append(
            f"{sum(left.values())} rows instead of {sum(right.values())}; "
            f"extra {list((left - right).items())[:3]}, lacking {list((right - left).items())[:3]}"
        )
    return found
