"""Runs a registered query on Spark and its SQL on DuckDB and compares the results."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

from workloads.fixtures import TABLES

# DuckDB result types by the Spark types they must come with.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def plain(value):
    """A value in a form both engines agree on."""
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda n: names[n])
    return Counter(tuple(plain(row[n]) for n in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and its SQL; empty when they agree."""
    spark_rows = rows_of(df.columns, df.collect())
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    duck_rows = rows_of(names, cursor.fetchall())
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema:
        kind = field.dataType.simpleString()
        if TYPES.get(kind) != kinds[field.name]:
            found.append(f"type of {field.name}: {kind} against {kinds[field.name]}")
    if spark_rows != duck_rows:
        left, right = spark_rows - duck_rows, duck_rows - spark_rows
        found.append(
            f"{sum(spark_rows.values())} rows against {sum(duck_rows.values())}; "
            f"only Spark {sum(left.values())}: {list(left)[:2]}; "
            f"only SQL {sum(right.values())}: {list(right)[:2]}"
        )
    if not spark_rows:
        found.append("no rows")
    return found
