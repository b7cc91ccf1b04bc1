"""Inventory, account and privilege tables of a server, read over JDBC.

Password hashes are not read; the server itself says whether there is one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.access import DATABASE_FLAGS, GLOBAL_FLAGS, LIMITS
from tablesync.sources import jdbc

# Where a MySQL server keeps each frame, and what is read of it.
FRAMES: dict[str, tuple[str, tuple[str, ...]]] = {
    "schemata": ("information_schema.SCHEMATA", ("SCHEMA_NAME AS table_schema",)),
    "tables": (
        "information_schema.TABLES",
        ("TABLE_SCHEMA AS table_schema", "TABLE_NAME AS table_name", "TABLE_TYPE AS table_type"),
    ),
    "columns": (
        "information_schema.COLUMNS",
        (
            "TABLE_SCHEMA AS table_schema", "TABLE_NAME AS table_name",
            "ORDINAL_POSITION AS ordinal_position", "COLUMN_NAME AS column_name",
            "COLUMN_TYPE AS column_type", "IS_NULLABLE AS is_nullable",
            "COLUMN_DEFAULT AS column_default", "EXTRA AS extra",
            "CHARACTER_SET_NAME AS character_set_name", "COLLATION_NAME AS collation_name",
        ),
    ),
    "statistics": (
        "information_schema.STATISTICS",
        (
            "TABLE_SCHEMA AS table_schema", "TABLE_NAME AS table_name",
            "INDEX_NAME AS index_name", "SEQ_IN_INDEX AS seq_in_index",
            "COLUMN_NAME AS column_name", "NON_UNIQUE AS non_unique",
        ),
    ),
    "key_column_usage": (
        "information_schema.KEY_COLUMN_USAGE",
        (
            "TABLE_SCHEMA AS table_schema", "TABLE_NAME AS table_name",
            "CONSTRAINT_NAME AS constraint_name", "ORDINAL_POSITION AS ordinal_position",
            "COLUMN_NAME AS column_name",
        ),
    ),
    "references": (
        "information_schema.KEY_COLUMN_USAGE",
        (
            "TABLE_SCHEMA AS table_schema", "TABLE_NAME AS table_name",
            "CONSTRAINT_NAME AS constraint_name", "ORDINAL_POSITION AS ordinal_position",
            "COLUMN_NAME AS column_name", "REFERENCED_TABLE_SCHEMA AS referenced_table_schema",
            "REFERENCED_TABLE_NAME AS referenced_table_name",
            "REFERENCED_COLUMN_NAME AS referenced_column_name",
        ),
    ),
    "accounts": (
        "mysql.user",
        (
            "User AS user", "Host AS host", "plugin AS plugin",
            "authentication_string <> '' AS has_password", "ssl_type AS ssl_type",
            *[f"{limit} AS {limit}" for limit in LIMITS],
        ),
    ),
    "grants_global": (
        "mysql.user", ("User AS user", "Host AS host", *[f"{f} AS {f}" for f in GLOBAL_FLAGS])
    ),
    "grants_db": (
        "mysql.db",
        ("User AS user", "Host AS host", "Db AS db", *[f"{f} AS {f}" for f in DATABASE_FLAGS]),
    ),
    "grants_set": (
        "mysql.tables_priv",
        (
            "User AS user", "Host AS host", "Db AS db", "Table_name AS table_name",
            "Table_priv AS table_priv", "Column_priv AS column_priv",
        ),
    ),
}


def frame_query(frame: str) -> str:
    """The subquery that a server answers for one frame."""
    table, items = FRAMES[frame]
    return f"(SELECT {', '.join(items)} FROM {table}) t"


def read_frame(spark: SparkSession, frame: str, servers: dict[str, str]) -> DataFrame:
    """One frame of all servers, given their JDBC addresses by name."""
    parts: Sequence[DataFrame] = [
        jdbc.read_jdbc(spark, jdbc.read_options(url, frame_query(frame))).select(
            F.lit(name).alias("server"), "*"
        )
        for name, url in servers.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
