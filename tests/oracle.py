"""Compare a query's rows with those of its SQL."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*[f"`{name}`" for name in names]).collect()
    return names, Counter(tuple(_plain(v) for v in row) for row in rows)


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    order = [columns.index(name) for name in names]
    return names, Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())


def sql_types(connection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}


TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def spark_types(df: DataFrame) -> dict[str, str]:
    return {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
