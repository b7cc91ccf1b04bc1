"""Keyed writes and whole-table copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.operators import keyed as K
from tablesync.plans.copy import copy_table, copy_tables
from tablesync.plans.merge import merge_rows
from tablesync.plans.structure import ensure_tables
from tablesync.session import fresh_path, stage
from tablesync.sources.records import ColumnRule, TableRecord
from tablesync.sources.tables import append_rows
from tablesync.sources.tables import truncate_load as load
from tablesync.sources.versions import open_table
from workloads.cleaning import clean_sql
from workloads.fixtures import RUN_TS, TABLES
from workloads.registry import SQL, query

ORDERS = TableSpec("shop", "orders", ("o_orderkey",))
LINE_KEY = ["l_orderkey", "l_linenumber"]
BATCH_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]
LATEST = ", ".join(f"{c} DESC" for c in BATCH_ORDER)
EARLIEST = ", ".join(BATCH_ORDER)


@query("truncate_load", "SELECT * FROM {orders}")
def truncate_load(i):
    path = fresh_path(i.spark, "truncate")
    load(i["dst_prefix"], path)
    return load(i["orders"], path)


@query("append_increment", """
SELECT * FROM {dst_prefix}
UNION ALL
SELECT * FROM {orders} WHERE o_orderkey > (SELECT max(o_orderkey) FROM {dst_prefix})""")
def append_increment(i):
    path = fresh_path(i.spark, "append")
    dest = load(i["dst_prefix"], path)
    new_rows = K.incremental_rows(i["orders"], dest, ["o_orderkey"])
    append_rows(new_rows, path)
    return i.spark.read.parquet(path)


@query("replace_into", f"""
SELECT * FROM {{li_dest}} d
WHERE NOT EXISTS (SELECT 1 FROM {{li_batch}} b
                  WHERE b.l_orderkey = d.l_orderkey AND b.l_linenumber = d.l_linenumber)
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LATEST}) AS rn
      FROM {{li_batch}})
WHERE rn = 1""")
def replace_into(i):
    return K.replace_into(i["li_dest"], i["li_batch"], LINE_KEY, BATCH_ORDER)


MERGED = SQL["replace_into"]


@query("merge_rows", MERGED)
def merged(i):
    """The same into a stored table of ten ranges, of which only those with a key of the batch are written."""
    spec, root = TableSpec("shop", "items", tuple(LINE_KEY)), fresh_path(i.spark, "merge")
    dest = stage(i["li_dest"], "items")
    copy_table(dest, spec, RUN_TS, root=root, rows_per_range=max(1, dest.count() // 10))
    merge_rows(i["li_batch"], spec, root, BATCH_ORDER)
    return open_table(i.spark, root, spec)


# A batch row survives when none after it shares a key: stated pair by pair here.
LATER = """EXISTS (SELECT 1 FROM {two_unique_batch} later
    WHERE later.seq > b.seq AND (later.c_custkey = b.c_custkey OR later.c_name = b.c_name))"""


@query("replace_into_multi_unique", f"""
SELECT * FROM {{customer}} d
WHERE d.c_custkey NOT IN (SELECT c_custkey FROM {{two_unique_batch}})
  AND d.c_name NOT IN (SELECT c_name FROM {{two_unique_batch}} WHERE c_name IS NOT NULL)
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {{two_unique_batch}} b
WHERE NOT {LATER}""")
def replace_into_multi_unique(i):
    return K.replace_into_multi_unique(
        i["customer"], i["two_unique_batch"], [["c_custkey"], ["c_name"]], ["seq"]
    )


@query("dropped_by_replace", f"SELECT * FROM {{two_unique_batch}} b WHERE {LATER}")
def dropped_by_replace(i):
    return K.dropped_by_replace(
        i["two_unique_batch"], [["c_custkey"], ["c_name"]], ["seq"]
    )


@query("insert_ignore", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {EARLIEST}) AS rn
      FROM {{li_batch}})
WHERE rn = 1 AND row(l_orderkey, l_linenumber) NOT IN
      (SELECT row(l_orderkey, l_linenumber) FROM {{li_dest}})""")
def insert_ignore(i):
    return K.insert_ignore(i["li_batch"], LINE_KEY, BATCH_ORDER, i["li_dest"])


@query("incremental_rows", """
SELECT * FROM {orders} WHERE o_orderkey > (SELECT max(o_orderkey) FROM {dst_prefix})""")
def incremental_rows(i):
    return K.incremental_rows(i["orders"], i["dst_prefix"], ["o_orderkey"])


def placed(i, fixture: str, label: str) -> tuple[str, ...]:
    """A destination to copy into, written from a fixture."""
    path = fresh_path(i.spark, label)
    i[fixture].write.parquet(path)
    return (path,)


CLEAN_ORDERS = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {clean_sql('created_at', True)} AS created_at,
       {clean_sql('last_modified', True)} AS last_modified,
       {clean_sql('shipped_date', False)} AS shipped_date
FROM {{dirty_orders}}"""


@query("copy_table", f"""
{CLEAN_ORDERS}
UNION ALL
SELECT * FROM {{dst_holes}} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {{orders}})""")
def copy_table_full(i):
    where = placed(i, "dst_holes", "holes")
    return copy_table(i["dirty_orders"], ORDERS, RUN_TS, where, mode="full").destination


@query("copy_table_resume", f"""
SELECT * FROM {{dst_dirty_prefix}}
UNION ALL
{CLEAN_ORDERS}
WHERE o_orderkey > (SELECT max(o_orderkey) FROM {{dst_dirty_prefix}})""")
def copy_table_resume(i):
    where = placed(i, "dst_dirty_prefix", "prefix")
    return copy_table(i["dirty_orders"], ORDERS, RUN_TS, where, mode="resume").destination


@query("copy_table_fresh", CLEAN_ORDERS)
def copy_table_fresh(i):
    return copy_table(i["dirty_orders"], ORDERS, RUN_TS).destination


@query("copy_table_binary", """
SELECT o_orderkey, o_orderstatus, upper(sha256(CAST(o_orderkey AS VARCHAR))) AS digest
FROM {orders}""")
def copy_table_binary(i):
    """Bytes that are no text, copied in key ranges below a root and read back."""
    digest = F.unhex(F.sha2(F.col("o_orderkey").cast("string"), 256))
    source = i["orders"].select("o_orderkey", "o_orderstatus", digest.alias("digest"))
    root = fresh_path(i.spark, "binary")
    copy_table(source, ORDERS, RUN_TS, root=root, rows_per_range=max(1, source.count() // 3))
    return open_table(i.spark, root, ORDERS).withColumn("digest", F.hex("digest"))


@query("copy_with_record", f"""
SELECT o_orderkey, o_custkey, 'P' AS o_orderstatus, CAST('0.5' AS DOUBLE) AS discount,
       CAST(NULL AS VARCHAR) AS remark, TIMESTAMP '{RUN_TS}' AS placed_at
FROM {{orders}}""")
def copy_with_record(i):
    """Two columns of a table, copied in ranges into one that has defaults for four more."""
    rules = [ColumnRule("o_orderkey", "bigint", False), ColumnRule("o_custkey", "bigint", False),
             ColumnRule("o_orderstatus", "string", False, "P"), ColumnRule("discount", "double", False, "0.5"),
             ColumnRule("remark", "string", True, "NULL"),
             ColumnRule("placed_at", "timestamp_ntz", False, "CURRENT_TIMESTAMP")]
    record, root = TableRecord(tuple(rules), ORDERS.keys), fresh_path(i.spark, "record")
    ensure_tables(i.spark, {ORDERS: i.spark.createDataFrame([], record.schema)}, root,
                  records={ORDERS: record})
    source = i["orders"].select(F.col("o_custkey").cast("bigint"), F.col("o_orderkey").cast("bigint"))
    copy_table(source, ORDERS, RUN_TS, root=root, rows_per_range=max(1, source.count() // 3))
    return open_table(i.spark, root, ORDERS)


@query("copy_tables", " UNION ALL ".join(
    f"SELECT {n} AS \"index\", 'given' AS schema_name, '{t}' AS table_name, count(*) AS \"rows\", "
    f"'COMPLETED' AS status, CAST(NULL AS VARCHAR) AS error FROM {t}"
    for n, t in enumerate(TABLES, start=1)
).replace("SELECT 1 AS", "SELECT CAST(1 AS BIGINT) AS", 1))
def copy_all_tables(i):
    sources = {TableSpec("given", t): i[t] for t in TABLES}
    report, _ = copy_tables(i.spark, sources, RUN_TS)
    return report.select(
        "index", "schema_name", "table_name", "rows", "status", F.col("error")
    )
