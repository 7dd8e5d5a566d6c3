"""Row-by-row comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from typing import Any

import duckdb
from pyspark.sql import DataFrame

from millrace.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def plain(value: Any) -> Any:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime):
        return value.isoformat(" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows(names: list[str], values: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(plain(row[i]) for i in order) for row in values)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both agree in column names, row count and values."""
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    expected = rows(names, result.fetchall())
    actual = rows(df.columns, [tuple(r) for r in df.collect()])
    if expected == actual:
        return ""
    return (
        f"{actual.total()} rows instead of {expected.total()}; "
        f"only Spark: {list((actual - expected).items())[:3]}; "
        f"only DuckDB: {list((expected - actual).items())[:3]}"
    )
