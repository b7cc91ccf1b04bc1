"""The streaming forms: the given Parquet file arrives as a stream and is read to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.session import fresh_path
from tablesync.streaming import jobs as J
from workloads.cleaning import CLEAN_DATES
from workloads.fixtures import FIXTURES, RUN_TS, dirty_text
from workloads.keyed import CLEAN_ORDERS
from workloads.ledger import STATE_SQL
from workloads.registry import query


def stream_of(i, table: str):
    # The glob matches the table whether it is a single file or a folder of files.
    return J.read_files(i.spark, i.path(table) + "*", i[table].schema)


def dirty_stream(i):
    """The ``dirty_orders`` fixture on the stream of orders."""
    return stream_of(i, "orders").select(
        "*",
        F.expr(dirty_text("o_orderkey")).alias("created_at"),
        F.expr(dirty_text("o_orderkey + 3")).alias("last_modified"),
        F.expr(dirty_text("o_orderkey + 6")).alias("shipped_date"),
    )


@query("stream_copy", f"""
{CLEAN_ORDERS}
UNION ALL
SELECT * FROM {{dst_holes}} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {{orders}})""")
def stream_copy(i):
    return J.stream_copy(
        dirty_stream(i), i["dst_holes"], ["o_orderkey"], ["o_orderdate"], RUN_TS,
        fresh_path(i.spark, "increments"), fresh_path(i.spark, "stream"),
    )


@query("stream_sanitize", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {CLEAN_DATES}
FROM {{dirty_orders}}""")
def stream_sanitize(i):
    return J.stream_sanitize(
        dirty_stream(i), RUN_TS, fresh_path(i.spark, "clean"), fresh_path(i.spark, "stream")
    )


@query("stream_ledger", STATE_SQL)
def stream_ledger(i):
    events = i.spark.sql(FIXTURES["ledger_events"], events=stream_of(i, "events"))
    return J.stream_ledger(
        events, fresh_path(i.spark, "states"), fresh_path(i.spark, "stream")
    )
