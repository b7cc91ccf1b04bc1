"""Frames derived from the given tables, in SQL that Spark and DuckDB both run.

They put whole tables into the shape an operator expects: orders with broken
dates, a destination with holes, catalog rows, accounts, ledger events. Every
row of a table takes part. What is to be missing somewhere keeps its row under
another key or name.
"""

from __future__ import annotations

from datetime import datetime

from tablesync.operators.access import GLOBAL_FLAGS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

RUN_TS = datetime(2024, 6, 1, 12, 0, 0)
RUN_TEXT = RUN_TS.strftime("%Y-%m-%d %H:%M:%S")
RUN_DATE = RUN_TS.strftime("%Y-%m-%d")


def dirty_text(number: str) -> str:
    """A date text, broken in one of several ways by the number."""
    return f"""CASE ({number}) % 9
            WHEN 0 THEN '0000-00-00 00:00:00' WHEN 1 THEN '0000-00-00'
            WHEN 2 THEN '1000-01-01' WHEN 3 THEN '1000-01-01 00:00:00'
            WHEN 4 THEN '1000-01-01 12:00:00' WHEN 5 THEN NULL
            WHEN 6 THEN '0000-00-00-note' ELSE '2024-01-02 03:04:05' END"""


def flag_columns(key: str, flags: tuple[str, ...]) -> str:
    """Y/N flags by key; some rows have none set, some only the grant option."""
    return ",\n    ".join(
        f"""CASE WHEN {key} % 13 = 0 THEN '{'Y' if flag == 'Grant_priv' else 'N'}'
             WHEN {key} % 11 = 0 THEN 'N'
             WHEN ({key} * 31 + {j * 17}) % 5 = 0 THEN 'Y' ELSE 'N' END AS {flag}"""
        for j, flag in enumerate(flags)
    )


def user_of(key: str) -> str:
    return f"""CASE WHEN {key} % 101 = 1 THEN '' WHEN {key} % 101 = 2 THEN 'root'
        WHEN {key} % 101 = 3 THEN 'mysql.sys' WHEN {key} % 101 = 4 THEN 'mysql.backup'
        WHEN {key} % 101 = 5 THEN concat('o''hara', CAST({key} AS STRING))
        ELSE concat('user', CAST({key} AS STRING)) END"""


def host_of(key: str) -> str:
    return f"""CASE {key} % 3 WHEN 0 THEN '%' WHEN 1 THEN 'localhost' ELSE '10.0.0.%' END"""


def server_of(key: str) -> str:
    return f"concat('srv', CAST({key} % 4 AS STRING))"


FIXTURES: dict[str, str] = {
    # Orders with three date texts, each broken in its own rhythm.
    "dirty_orders": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {dirty_text('o_orderkey')} AS created_at,
       {dirty_text('o_orderkey + 3')} AS last_modified,
       {dirty_text('o_orderkey + 6')} AS shipped_date
FROM {{orders}}""",
    # Destinations: a key-order prefix, and one with stale rows and with rows gone at the source
    # in place of some of its keys.
    "dst_prefix": """
SELECT * FROM {orders}
WHERE o_orderkey < (SELECT CAST(floor(max(o_orderkey) * 4 / 5) AS BIGINT) FROM {orders})""",
    "dst_dirty_prefix": """
SELECT * FROM {dirty_orders}
WHERE o_orderkey < (SELECT CAST(floor(max(o_orderkey) * 4 / 5) AS BIGINT) FROM {orders})""",
    "dst_holes": """
SELECT CASE WHEN o_orderkey % 10 IN (0, 3) THEN o_orderkey + 1000000000000 ELSE o_orderkey END
         AS o_orderkey,
       o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority,
       'stale' AS created_at, 'stale' AS last_modified, 'stale' AS shipped_date
FROM {dirty_orders}""",
    # A source whose keys have gaps.
    "src_gaps": """
SELECT o_orderkey * 2 + o_orderkey % 2 AS o_orderkey, o_custkey, o_totalprice, o_orderdate
FROM {orders}""",
    # Order lines: a destination unique by key, of which returned lines have keys that no batch
    # row has, and a batch of all lines with keys several times over, some of them new.
    "li_dest": """
SELECT CASE WHEN l_returnflag = 'R' THEN l_orderkey + 1000000000000 ELSE l_orderkey END
         AS l_orderkey,
       l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey,
       max(l_quantity) + 100 AS l_quantity, max(l_extendedprice) AS l_extendedprice,
       max(l_shipdate) AS l_shipdate
FROM {lineitem}
GROUP BY CASE WHEN l_returnflag = 'R' THEN l_orderkey + 1000000000000 ELSE l_orderkey END,
         l_linenumber""",
    "li_batch": """
SELECT CASE WHEN l_linestatus = 'O' THEN l_orderkey ELSE l_orderkey + 2000000000000 END
         AS l_orderkey,
       l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
FROM {lineitem}""",
    # Customers under two unique keys; the batch holds each customer twice, moves names about,
    # repeats keys and brings customers from some nations in under new keys.
    "two_unique_batch": """
SELECT CASE WHEN c_nationkey < 12 THEN c_custkey ELSE c_custkey + 1000000000000 END AS c_custkey,
       CASE WHEN c_custkey % 7 = 0 THEN NULL
            WHEN c_nationkey >= 12 THEN concat('New#', CAST(c_custkey AS STRING))
            WHEN c_custkey % 4 = 0 THEN concat('Customer#', lpad(CAST(c_custkey + 1 AS STRING), 9, '0'))
            ELSE c_name END AS c_name,
       c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment, c_custkey * 2 AS seq
FROM {customer}
UNION ALL
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey - c_custkey % 3
            ELSE c_custkey + 2000000000000 END AS c_custkey,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name END AS c_name,
       c_nationkey, c_acctbal + 2 AS c_acctbal, c_mktsegment, c_custkey * 2 + 1 AS seq
FROM {customer}""",
    # Orders with some missing references, and customers of which every fifth has another key now.
    "orders_null_fk": """
SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       o_totalprice
FROM {orders}""",
    "kept_customers": """
SELECT CASE WHEN c_custkey % 5 = 0 THEN c_custkey + 1000000000000 ELSE c_custkey END AS c_custkey,
       c_name
FROM {customer}""",
    # Row counts per order priority at the source and the destination.
    "counts_src": """
SELECT o_orderpriority AS table_name, count(*) AS total_records FROM {orders}
GROUP BY o_orderpriority""",
    "counts_dst": """
SELECT table_name, count(*) AS total_records
FROM (SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0 THEN 'unknown'
                  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
                  ELSE o_orderpriority END AS table_name
      FROM {orders}) AS placed
GROUP BY table_name""",
    "counts_src_unreadable": """
SELECT table_name, CASE WHEN table_name = '5-LOW' THEN NULL ELSE total_records END
         AS total_records
FROM {counts_src}""",
    # Ledger events: users stand for tables, tens of days for runs.
    "ledger_events": """
SELECT concat('run-', CAST(CAST(floor((day(ts) - 1) / 10) AS BIGINT) AS STRING)) AS run_id,
       event_id, ts, concat('db.t', CAST(user_id AS STRING)) AS table_key,
       CASE event_type WHEN 'signup' THEN 'start' WHEN 'purchase' THEN 'complete'
            WHEN 'error' THEN 'error' ELSE 'progress' END AS op,
       CASE WHEN event_type = 'signup' THEN CAST(floor(value * 100) AS BIGINT) END AS total_rows,
       CASE WHEN event_type IN ('click', 'view', 'error') THEN event_id END AS last_id,
       CASE WHEN event_type IN ('click', 'view')
            THEN CAST(floor(value) AS BIGINT) * 1000 + event_id % 2 END AS processed_rows,
       CASE WHEN event_type = 'error' THEN props END AS message
FROM {events}""",
    "ledger_with_totals": """
SELECT run_id, event_id, ts, table_key, op, total_rows, last_id, processed_rows, message
FROM {ledger_events}
UNION ALL
SELECT run_id, min(event_id) - 1 AS event_id, min(ts) AS ts, CAST(NULL AS STRING) AS table_key,
       'set_totals' AS op, 200 + count(DISTINCT table_key) AS total_rows,
       CAST(NULL AS BIGINT) AS last_id, CAST(NULL AS BIGINT) AS processed_rows,
       CAST(NULL AS STRING) AS message
FROM {ledger_events} GROUP BY run_id""",
    "ledger_tables": """
SELECT concat('db.t', CAST(user_id AS STRING)) AS table_key, count(*) AS total_records
FROM {events} GROUP BY user_id
UNION ALL
SELECT concat('new.', r_name) AS table_key, CAST(r_regionkey AS BIGINT) AS total_records
FROM {region}""",
    # Marks of the destinations that can be read; some are empty, some behind the ledger. Every
    # fifth is a destination of something else, so the table's own cannot be read.
    # Orders, and a copy that lost, doubled and changed some and holds some that are gone.
    "orders_seen": """
SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}""",
    "orders_copied": """
SELECT CASE WHEN o_orderkey % 503 = 11 THEN o_orderkey + 1000000000000 ELSE o_orderkey END AS o_orderkey,
       CASE WHEN o_orderkey % 499 = 7 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_totalprice
FROM {orders} WHERE o_orderkey % 501 <> 5
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderkey % 507 = 3 AND o_orderkey % 501 <> 5
  AND o_orderkey % 499 <> 7 AND o_orderkey % 503 <> 11""",
    "part_tree": """
SELECT p_partkey AS id, CASE WHEN p_partkey >= 2 THEN CAST(floor(p_partkey / 2) AS BIGINT) END AS parent_id
FROM {part}""",
    "dest_marks": """
SELECT concat(CASE WHEN user_id % 5 = 0 THEN 'other.t' ELSE 'db.t' END,
              CAST(user_id AS STRING)) AS table_key,
       CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 3 = 0 THEN min(event_id)
            ELSE max(event_id) END AS dest_mark
FROM {events} GROUP BY user_id""",
    "call_log": """
SELECT CASE WHEN event_id % 2 = 0 THEN 'source' ELSE 'destination' END AS server, ts,
       CASE event_id % 3 WHEN 0 THEN 'query' WHEN 1 THEN 'queryrow' ELSE 'exec' END AS kind,
       value / 40 AS duration, CASE WHEN event_type = 'error' THEN props END AS error
FROM {events}""",
    # Catalog rows: eight parts make a table, ten tables a schema.
    "cat_rows": """
SELECT p_partkey, p_name, p_size,
       CAST(floor(p_partkey / 8) AS BIGINT) AS t, CAST(floor(p_partkey / 80) AS BIGINT) AS s,
       CAST(p_partkey % 8 + 1 AS INT) AS pos
FROM {part}""",
    "cat_columns": """
SELECT concat('srv', CAST(s % 3 AS STRING)) AS server,
       CASE s % 12 WHEN 3 THEN 'mysql' WHEN 7 THEN 'sys'
            ELSE concat('db', CAST(s AS STRING)) END AS table_schema,
       concat('t', CAST(t AS STRING)) AS table_name,
       CASE WHEN t % 9 = 4 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
       t, pos AS ordinal_position,
       CASE pos WHEN 1 THEN 'id' WHEN 2 THEN 'tenant_id' WHEN 3 THEN 'created_at'
                WHEN 4 THEN 'LastUpdated' WHEN 5 THEN 'Creation_Date' WHEN 6 THEN 'body'
                WHEN 7 THEN replace(p_name, ' ', '_') ELSE 'last_modified_by' END AS column_name,
       CASE p_size % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'varchar(255)' WHEN 2 THEN 'timestamp'
                       ELSE 'json' END AS column_type,
       CASE WHEN p_size % 2 = 0 THEN 'YES' ELSE 'NO' END AS is_nullable,
       CASE WHEN pos = 3 THEN 'CURRENT_TIMESTAMP' WHEN p_size > 40 THEN '0' END AS column_default,
       CASE pos WHEN 1 THEN 'auto_increment' WHEN 4 THEN 'on update CURRENT_TIMESTAMP'
                WHEN 5 THEN NULL ELSE '' END AS extra,
       CASE WHEN pos IN (6, 7) THEN 'utf8mb4' END AS character_set_name,
       CASE WHEN pos IN (6, 7) THEN 'utf8mb4_unicode_ci' END AS collation_name
FROM {cat_rows}""",
    "cat_tables": """
SELECT DISTINCT server, table_schema, table_name, table_type FROM {cat_columns}""",
    "cat_schemata": "SELECT DISTINCT server, table_schema FROM {cat_columns}",
    "cat_base": """
SELECT * FROM {cat_tables}
WHERE table_type = 'BASE TABLE'
  AND table_schema NOT IN ('information_schema', 'performance_schema', 'mysql', 'sys')""",
    "cat_statistics": """
SELECT server, table_schema, table_name,
       CASE WHEN ordinal_position <= 2 AND t % 5 = 0 THEN 'idx_p'
            WHEN ordinal_position <= 2 THEN 'PRIMARY' WHEN ordinal_position <= 5 THEN 'idx_time'
            WHEN ordinal_position = 6 THEN 'uk_body' ELSE 'idx_rest' END AS index_name,
       CASE WHEN ordinal_position <= 2 THEN ordinal_position
            WHEN ordinal_position <= 5 THEN 6 - ordinal_position
            WHEN ordinal_position = 6 THEN 1 ELSE 9 - ordinal_position END AS seq_in_index,
       column_name,
       CASE WHEN ordinal_position <= 2 AND t % 5 <> 0 THEN 0 WHEN ordinal_position = 6 THEN 0
            ELSE 1 END AS non_unique
FROM {cat_columns}""",
    "cat_keys": """
SELECT server, table_schema, table_name,
       CASE WHEN t % 5 = 0 THEN 'uk_pair' ELSE 'PRIMARY' END AS constraint_name,
       3 - ordinal_position AS ordinal_position, column_name
FROM {cat_columns} WHERE ordinal_position <= 2
UNION ALL
SELECT server, table_schema, table_name, 'fk_tenant' AS constraint_name,
       1 AS ordinal_position, column_name
FROM {cat_columns} WHERE ordinal_position = 2""",
    # The destination's inventory has other names for a schema in five, a table in four, and one
    # index of some tables.
    "cat_dest_tables": """
SELECT DISTINCT concat('dst-', server) AS server,
       CASE WHEN t % 50 < 10 THEN concat('old_', table_schema) ELSE table_schema END AS table_schema,
       CASE WHEN t % 4 = 1 THEN concat('old_', table_name) ELSE table_name END AS table_name
FROM {cat_columns}""",
    "cat_dest_statistics": """
SELECT concat('dst-', server) AS server, table_schema, table_name,
       CASE WHEN index_name = 'uk_body' AND table_name LIKE '%2' THEN 'uk_other'
            ELSE index_name END AS index_name
FROM {cat_statistics}""",
    # Accounts and privileges: customers stand for accounts.
    "accounts": f"""
SELECT {server_of('c_custkey')} AS server, {user_of('c_custkey')} AS user,
       {host_of('c_custkey')} AS host,
       CASE c_custkey % 5 WHEN 0 THEN 'mysql_native_password' WHEN 1 THEN 'caching_sha2_password'
            WHEN 2 THEN 'sha256_password' WHEN 3 THEN 'auth_socket' ELSE NULL END AS plugin,
       c_acctbal > 0 AS has_password,
       CASE c_custkey % 4 WHEN 0 THEN 'ANY' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'X509' END
         AS ssl_type,
       CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE CAST(c_nationkey % 4 AS BIGINT) END
         AS max_questions,
       CASE WHEN c_nationkey % 2 = 0 THEN CAST(0 AS BIGINT) END AS max_updates,
       CAST(0 AS BIGINT) AS max_connections,
       CASE WHEN c_nationkey > 20 THEN CAST(c_nationkey AS BIGINT) END AS max_user_connections
FROM {{customer}}""",
    "grants_global": f"""
SELECT {server_of('c_custkey')} AS server, {user_of('c_custkey')} AS user,
       {host_of('c_custkey')} AS host,
    {flag_columns('c_custkey', GLOBAL_FLAGS)}
FROM {{customer}}""",
    "grants_db": f"""
SELECT {server_of('o_custkey')} AS server, {user_of('o_custkey')} AS user,
       {host_of('o_custkey')} AS host,
       concat('db`', CAST(o_orderkey % 6 AS STRING)) AS db,
    {flag_columns('o_orderkey', GLOBAL_FLAGS)}
FROM {{orders}}""",
    "grants_set": f"""
SELECT {server_of('o_custkey')} AS server, {user_of('o_custkey')} AS user,
       {host_of('o_custkey')} AS host,
       concat('db', CAST(o_orderkey % 6 AS STRING)) AS db,
       concat('t', CAST(o_orderkey AS STRING)) AS table_name,
       CASE o_orderkey % 5 WHEN 0 THEN 'Select, Insert' WHEN 1 THEN 'Select,Grant,References'
            WHEN 2 THEN '' WHEN 3 THEN 'Grant' ELSE 'Delete,drop , ALTER,Index,Trigger' END
         AS table_priv,
       'Select' AS column_priv
FROM {{orders}}""",
    # Ids for the generators, 1 and up, as many as the given tables have rows.
    "user_ids": "SELECT c_custkey + 1 AS id FROM {customer}",
    "product_ids": "SELECT p_partkey + 1 AS id FROM {part}",
    "order_ids": "SELECT o_orderkey + 1 AS id FROM {orders}",
    "item_ids": """
SELECT o_orderkey * 3 + 1 AS id FROM {orders}
UNION ALL SELECT o_orderkey * 3 + 2 AS id FROM {orders}
UNION ALL SELECT o_orderkey * 3 + 3 AS id FROM {orders}""",
    "author_ids": "SELECT s_suppkey + 1 AS id FROM {supplier}",
    "event_ids": "SELECT event_id + 1 AS id FROM {events}",
}
