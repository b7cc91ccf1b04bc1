"""Inventory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.operators import catalog as C
from tablesync.operators.counts import row_counts
from tablesync.plans.structure import ensure_tables as create_tables
from tablesync.session import fresh_path
from tablesync.sources.versions import open_table
from workloads.fixtures import TABLES
from workloads.registry import query

SYSTEM = "('information_schema', 'performance_schema', 'mysql', 'sys')"
T = "server, table_schema, table_name"


def joined(column: str):
    return F.concat_ws(",", column).alias(column)


@query("user_schemas", f"""
SELECT server, table_schema FROM {{cat_schemata}} WHERE table_schema NOT IN {SYSTEM}""")
def user_schemas(i):
    return C.user_schemas(i["cat_schemata"])


@query("base_tables", f"""
SELECT server, table_schema, table_name, table_type FROM {{cat_tables}}
WHERE table_schema NOT IN {SYSTEM} AND table_type = 'BASE TABLE'""")
def base_tables(i):
    return C.base_tables(i["cat_tables"])


COLUMNS_SQL = f"""
SELECT {T}, ordinal_position, column_name, column_type, is_nullable = 'YES' AS is_nullable,
       column_default, extra IS NOT NULL AND extra = 'auto_increment' AS is_auto_increment,
       character_set_name, collation_name
FROM {{cat_columns}}
WHERE table_schema NOT IN {SYSTEM} AND table_type = 'BASE TABLE'"""


@query("catalog_columns", COLUMNS_SQL)
def catalog_columns(i):
    return C.catalog_columns(i["cat_columns"], C.base_tables(i["cat_tables"]))


@query("nested_columns", f"""
SELECT {T}, count(*) AS n_columns,
       string_agg(column_name || ':' || column_type, ',' ORDER BY ordinal_position) AS columns
FROM ({COLUMNS_SQL}) GROUP BY ALL""")
def nested_columns(i):
    nested = C.nested_columns(catalog_columns(i))
    text = F.transform(
        "columns", lambda c: F.concat(c["column_name"], F.lit(":"), c["column_type"])
    )
    return nested.select(
        *C.TABLE,
        F.size("columns").cast("bigint").alias("n_columns"),
        F.concat_ws(",", text).alias("columns"),
    )


@query("index_groups", f"""
SELECT {T}, index_name, string_agg(column_name, ',' ORDER BY seq_in_index) AS columns,
       min(non_unique) = 0 AS is_unique, index_name = 'PRIMARY' AS is_primary
FROM {{cat_statistics}} GROUP BY {T}, index_name""")
def index_groups(i):
    groups = C.index_groups(i["cat_statistics"])
    return groups.select(
        *C.TABLE, "index_name", joined("columns"), "is_unique", "is_primary"
    )


@query("primary_keys", f"""
SELECT {T}, string_agg(column_name, ',' ORDER BY ordinal_position) AS key_columns
FROM {{cat_keys}} WHERE constraint_name = 'PRIMARY' GROUP BY {T}""")
def primary_keys(i):
    return C.primary_keys(i["cat_keys"]).select(*C.TABLE, joined("key_columns"))


@query("first_key_column", f"""
SELECT t.server, t.table_schema, t.table_name, coalesce(f.key_column, 'id') AS key_column
FROM {{cat_tables}} t
LEFT JOIN (SELECT c.server, c.table_schema, c.table_name,
                  arg_min(c.column_name, c.ordinal_position) AS key_column
           FROM {{cat_columns}} c JOIN {{cat_keys}} k
             ON k.constraint_name = 'PRIMARY' AND k.server = c.server
            AND k.table_schema = c.table_schema AND k.table_name = c.table_name
            AND k.column_name = c.column_name
           GROUP BY c.server, c.table_schema, c.table_name) f
  ON t.server = f.server AND t.table_schema = f.table_schema AND t.table_name = f.table_name""")
def first_key_column(i):
    return C.first_key_column(i["cat_tables"], i["cat_columns"], i["cat_keys"])


@query("table_schemas", f"""
SELECT {T}, count(*) AS n_columns,
       string_agg('`' || column_name || '` '
         || CASE column_type WHEN 'int' THEN 'int' WHEN 'timestamp' THEN 'timestamp_ntz'
                             ELSE 'string' END
         || CASE WHEN is_nullable = 'NO' THEN ' NOT NULL' ELSE '' END,
         ', ' ORDER BY ordinal_position) AS ddl
FROM {{cat_columns}} GROUP BY {T}""")
def table_schemas(i):
    return C.table_schemas(i["cat_columns"])


@query("order_columns", f"""
SELECT t.server, t.table_schema, t.table_name,
       coalesce(k.key_columns, c.first_column, '1') AS order_columns
FROM {{cat_tables}} t
LEFT JOIN (SELECT {T}, string_agg(column_name, ',' ORDER BY ordinal_position) AS key_columns
           FROM {{cat_keys}} WHERE constraint_name = 'PRIMARY' GROUP BY {T}) k
  ON t.server = k.server AND t.table_schema = k.table_schema AND t.table_name = k.table_name
LEFT JOIN (SELECT {T}, arg_min(column_name, ordinal_position) AS first_column
           FROM {{cat_columns}} WHERE table_type = 'BASE TABLE' GROUP BY {T}) c
  ON t.server = c.server AND t.table_schema = c.table_schema AND t.table_name = c.table_name""")
def order_columns(i):
    # The columns of views are left out here, so that the last fallback shows as well.
    columns = i["cat_columns"].filter("table_type = 'BASE TABLE'")
    ordered = C.order_columns(i["cat_tables"], columns, i["cat_keys"])
    return ordered.select(*C.TABLE, joined("order_columns"))


@query("catalog_counts", f"""
SELECT CASE WHEN GROUPING(server) = 1 THEN 'all' WHEN GROUPING(table_schema) = 1 THEN 'server'
            WHEN GROUPING(table_name) = 1 THEN 'schema' ELSE 'table' END AS level,
       {T}, count(DISTINCT (server, table_schema)) AS n_schemas,
       count(DISTINCT (server, table_schema, table_name)) AS n_tables, count(*) AS n_columns
FROM ({COLUMNS_SQL}) GROUP BY ROLLUP ({T})""")
def catalog_counts(i):
    return C.catalog_counts(catalog_columns(i))


@query("select_targets", """
SELECT 'db1' AS target, server, table_schema, table_name, table_type FROM {cat_base}
WHERE table_schema = 'db1'
UNION ALL
SELECT 'db1.t12' AS target, server, table_schema, table_name, table_type FROM {cat_base}
WHERE table_schema = 'db1' AND table_name = 't12'""")
def select_targets(i):
    tables = i["cat_tables"]
    named = [
        C.select_targets(tables, target).select(F.lit(target).alias("target"), "*")
        for target in ("db1", "db1.t12")
    ]
    return named[0].unionByName(named[1])


@query("missing_objects", f"""
SELECT 'schema' AS kind, server, table_schema, CAST(NULL AS VARCHAR) AS table_name,
       CAST(NULL AS VARCHAR) AS index_name
FROM (SELECT DISTINCT server, table_schema FROM {{cat_base}}) s
WHERE NOT EXISTS (SELECT 1 FROM {{cat_dest_tables}} d WHERE d.table_schema = s.table_schema)
UNION ALL
SELECT 'table', {T}, NULL
FROM (SELECT DISTINCT {T} FROM {{cat_base}}) s
WHERE NOT EXISTS (SELECT 1 FROM {{cat_dest_tables}} d
                  WHERE d.table_schema = s.table_schema AND d.table_name = s.table_name)
UNION ALL
SELECT 'index', {T}, index_name
FROM (SELECT DISTINCT {T}, index_name FROM {{cat_statistics}} WHERE index_name <> 'PRIMARY') s
WHERE NOT EXISTS (SELECT 1 FROM {{cat_dest_statistics}} d
                  WHERE d.table_schema = s.table_schema AND d.table_name = s.table_name
                    AND d.index_name = s.index_name)""")
def missing_objects(i):
    return C.missing_objects(
        i["cat_base"], i["cat_statistics"], i["cat_dest_tables"], i["cat_dest_statistics"]
    )


TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)
SOURCE_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS source_rows FROM {t}" for t in TABLES
)


@query("ensure_tables", f"""
SELECT 'copy' AS schema_name, c.table_name, count(*) AS n_columns, true AS created,
       any_value(s.source_rows) AS missing_rows
FROM (SELECT DISTINCT table_name, column_name FROM information_schema.columns
      WHERE table_name IN ({TABLE_LIST})) c
JOIN ({SOURCE_COUNTS}) s ON c.table_name = s.table_name
GROUP BY c.table_name""")
def ensure_tables(i):
    sources = {t: i[t] for t in TABLES}
    root = fresh_path(i.spark, "ensure")
    report = create_tables(
        i.spark, {TableSpec("copy", t): df for t, df in sources.items()}, root
    )
    made = {
        t: open_table(i.spark, root, TableSpec("copy", t), df.schema) for t, df in sources.items()
    }
    have = row_counts(made).withColumnRenamed("total_records", "dest_rows")
    want = row_counts(sources)
    return (
        report.join(want, "table_name")
        .join(have, "table_name")
        .select(
            "schema_name", "table_name", "n_columns", "created",
            (F.col("total_records") - F.col("dest_rows")).alias("missing_rows"),
        )
    )
