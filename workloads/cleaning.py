"""Cleaning and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators import clean as D
from tablesync.operators import validate as V
from workloads.fixtures import RUN_DATE, RUN_TEXT, RUN_TS, dirty_text
from workloads.registry import query

DATE_TEXTS = ["created_at", "last_modified", "shipped_date"]


def clean_sql(column: str, tracked: bool) -> str:
    moment, day = (RUN_TEXT, RUN_DATE) if tracked else ("1970-01-01 00:00:01", "1970-01-01")
    return f"""CASE WHEN {column} IS NULL THEN NULL
            WHEN {column} LIKE '0000-00-00%' OR {column} LIKE '1000-01-01 00:00:00%'
              THEN '{moment}'
            WHEN {column} = '1000-01-01' THEN '{day}' ELSE {column} END"""


CLEAN_DATES = f"""{clean_sql('created_at', True)} AS created_at,
       {clean_sql('last_modified', True)} AS last_modified,
       {clean_sql('shipped_date', False)} AS shipped_date"""


@query("sanitize_rows", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {CLEAN_DATES}
FROM {{dirty_orders}}""")
def sanitize_rows(i):
    return D.sanitize_rows(i["dirty_orders"], RUN_TS)


@query("sanitize_text_dates", f"SELECT o_orderkey, {CLEAN_DATES} FROM {{dirty_orders}}")
def sanitize_text_dates(i):
    rows = i["dirty_orders"].select("o_orderkey", *DATE_TEXTS)
    return D.sanitize_text_dates(rows, DATE_TEXTS, RUN_TS)


@query("sanitize_timestamps", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN '{RUN_TEXT}'
    WHEN o_orderkey % 13 = 1 THEN '1000-03-01 00:00:00'
    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate
FROM {{orders}}""")
def sanitize_timestamps(i):
    early = F.lit("0999-12-31 23:59:59").cast("timestamp_ntz")
    first_valid = F.lit("1000-03-01 00:00:00").cast("timestamp_ntz")
    rows = i["orders"].select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 == 0, early)
        .when(F.col("o_orderkey") % 13 == 1, first_valid)
        .otherwise(F.col("o_orderdate"))
        .alias("o_orderdate"),
    )
    clean = D.sanitize_timestamps(rows, ["o_orderdate"], RUN_TS)
    return clean.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("bytes_to_text", f"""
SELECT doc_id, text AS body, {clean_sql('created', True)} AS created
FROM (SELECT doc_id, text, {dirty_text('doc_id')} AS created FROM {{documents}})""")
def bytes_to_text(i):
    rows = i["documents"].select(
        "doc_id",
        F.encode("text", "UTF-8").alias("body"),
        F.encode(F.expr(dirty_text("doc_id")), "UTF-8").alias("created"),
    )
    return D.bytes_to_text(rows, ["body", "created"], RUN_TS)


@query("column_roles", """
SELECT server, table_schema, table_name, column_name,
       CASE WHEN lower(column_name) LIKE '%created%'
              OR lower(column_name) LIKE '%creation^_date%' ESCAPE '^' THEN 'created'
            WHEN lower(column_name) LIKE '%updated%'
              OR lower(column_name) LIKE '%modification^_date%' ESCAPE '^'
              OR lower(column_name) LIKE '%last^_modified%' ESCAPE '^' THEN 'updated'
            ELSE 'other' END AS role
FROM {cat_columns}""")
def column_roles(i):
    roles = D.column_roles(i["cat_columns"])
    return roles.select("server", "table_schema", "table_name", "column_name", "role")


@query("sanitize_report", " UNION ALL ".join(
    f"""SELECT 'shop.orders' AS table_key, '{c}' AS column_name, {c} AS before,
       {clean_sql(c, c != 'shipped_date')} AS after, count(*) AS "rows"
FROM {{dirty_orders}}
WHERE {c} IS DISTINCT FROM {clean_sql(c, c != 'shipped_date')}
GROUP BY 2, 3, 4"""
    for c in DATE_TEXTS
))
def sanitize_report(i):
    return D.sanitize_report(i["dirty_orders"], RUN_TS, "shop.orders")


@query("validate_rows", """
SELECT doc_id, 'text' AS column_name, 'too_long' AS rule,
       CAST(octet_length(encode(text)) AS DOUBLE) AS measure
FROM {documents} WHERE octet_length(encode(text)) > 2000""")
def validate_rows(i):
    return V.validate_rows(i["documents"], ["doc_id"], max_bytes=2000)


@query("validate_numbers", """
SELECT c_custkey, 'c_acctbal' AS column_name, 'too_large' AS rule, c_acctbal * 1e12 AS measure
FROM {customer} WHERE c_acctbal * 1e12 > 1e15""")
def validate_numbers(i):
    rows = i["customer"].withColumn("c_acctbal", F.col("c_acctbal") * F.lit(1e12))
    return V.validate_rows(rows, ["c_custkey"])


@query("enum_violations", """
SELECT o_orderkey, o_orderstatus FROM {orders} WHERE o_orderstatus NOT IN ('F', 'O')""")
def enum_violations(i):
    return V.enum_violations(i["orders"].select("o_orderkey", "o_orderstatus"),
                             "o_orderstatus", ["F", "O"])


@query("null_violations", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS nulls FROM {{dirty_orders}} WHERE {c} IS NULL"
    for c in DATE_TEXTS
))
def null_violations(i):
    return V.null_violations(i["dirty_orders"], ["o_orderkey", "o_totalprice", *DATE_TEXTS])


@query("unique_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM {lineitem}
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def unique_violations(i):
    return V.unique_violations(i["lineitem"], ["l_orderkey", "l_linenumber"])


@query("orphan_rows", """
SELECT * FROM {orders_null_fk} o
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM {kept_customers})""")
def orphan_rows(i):
    return V.orphan_rows(i["orders_null_fk"], "o_custkey", i["kept_customers"], "c_custkey")


@query("cascade_delete", """
SELECT * FROM {orders_null_fk} o
WHERE o_custkey IS NULL OR o_custkey IN (SELECT c_custkey FROM {kept_customers})""")
def cascade_delete(i):
    return V.cascade_delete(i["orders_null_fk"], "o_custkey", i["kept_customers"], "c_custkey")


@query("set_null_delete", """
SELECT o.o_orderkey, c.c_custkey AS o_custkey, o.o_totalprice
FROM {orders_null_fk} o LEFT JOIN {kept_customers} c ON o.o_custkey = c.c_custkey""")
def set_null_delete(i):
    return V.set_null_delete(i["orders_null_fk"], "o_custkey", i["kept_customers"], "c_custkey")


@query("apply_defaults", f"""
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, true AS is_active,
       CAST('{RUN_TEXT}' AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS shipped_date
FROM {{orders}}""")
def apply_defaults(i):
    rows = i["orders"].select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus")
    )
    return V.apply_defaults(
        rows,
        {
            "o_orderstatus": V.default_from_text("pending", "string", RUN_TS),
            "is_active": V.default_from_text("1", "boolean", RUN_TS),
            "created_at": V.default_from_text("CURRENT_TIMESTAMP", "timestamp_ntz", RUN_TS),
            "shipped_date": V.default_from_text("NULL", "timestamp_ntz", RUN_TS),
        },
    )
