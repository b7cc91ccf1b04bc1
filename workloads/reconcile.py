"""Verdicts and progress."""

from __future__ import annotations

from tablesync.operators import differences as D
from tablesync.operators import reconcile as R
from workloads.registry import query

CHECK_SQL = """
SELECT s.table_name, s.total_records AS src_rows, coalesce(d.total_records, 0) AS dest_rows,
       greatest(100, CAST(floor(s.total_records * 0.001) AS BIGINT)) AS tolerance,
       CASE WHEN coalesce(d.total_records, 0)
                 < s.total_records - greatest(100, floor(s.total_records * 0.001)) THEN 'short'
            WHEN coalesce(d.total_records, 0)
                 > s.total_records + greatest(100, floor(s.total_records * 0.001)) THEN 'over'
            ELSE 'ok' END AS verdict
FROM {counts_src} s LEFT JOIN {counts_dst} d ON s.table_name = d.table_name"""


@query("count_check", CHECK_SQL)
def count_check(i):
    return R.count_check(i["counts_src"], i["counts_dst"])


@query("count_in_range", """
SELECT s.table_name, s.total_records AS expected_rows, d.total_records AS actual_rows,
       abs(d.total_records - s.total_records)
         <= greatest(100, floor(s.total_records * 0.001)) AS in_range
FROM {counts_src} s JOIN {counts_dst} d ON s.table_name = d.table_name""")
def count_in_range(i):
    pairs = (
        i["counts_src"]
        .withColumnRenamed("total_records", "expected_rows")
        .join(i["counts_dst"].withColumnRenamed("total_records", "actual_rows"), "table_name")
    )
    return R.count_in_range(pairs)


REPORT_SQL = """
SELECT table_name, total_rows, processed_rows,
       CASE WHEN total_rows > 0
            THEN round(CAST(processed_rows AS DOUBLE) / total_rows * 100, 1) ELSE 0 END AS percent,
       CASE WHEN src IS NULL THEN 'Error' WHEN total_rows = processed_rows THEN 'Completed'
            ELSE 'In Progress' END AS status
FROM (SELECT coalesce(s.table_name, d.table_name) AS table_name, s.total_records AS src,
             coalesce(s.total_records, 0) AS total_rows,
             CASE WHEN s.total_records IS NULL THEN 0 ELSE coalesce(d.total_records, 0) END
               AS processed_rows
      FROM {counts_src_unreadable} s FULL JOIN {counts_dst} d ON s.table_name = d.table_name)"""


@query("progress_report", REPORT_SQL)
def progress_report(i):
    return R.progress_report(i["counts_src_unreadable"], i["counts_dst"])


@query("progress_totals", f"""
SELECT count(*) FILTER (status = 'Completed') AS completed_tables, count(*) AS total_tables,
       round(CAST(count(*) FILTER (status = 'Completed') AS DOUBLE) / count(*) * 100, 1)
         AS tables_percent,
       CAST(sum(processed_rows) AS BIGINT) AS processed_rows,
       CAST(sum(total_rows) AS BIGINT) AS total_rows,
       round(CAST(sum(processed_rows) AS DOUBLE) / sum(total_rows) * 100, 1) AS rows_percent
FROM ({REPORT_SQL})""")
def progress_totals(i):
    return R.progress_totals(progress_report(i))


@query("run_duration", """
SELECT run_id, table_key, min(ts) AS first_ts, max(ts) AS last_ts,
       round(date_diff('microsecond', min(ts), max(ts)) / 1e6, 3) AS seconds
FROM {ledger_events} GROUP BY run_id, table_key""")
def run_duration(i):
    return R.run_duration(i["ledger_events"])


DIFFERENT = """
SELECT {columns} FROM (
  SELECT o_orderkey, count(*) FILTER (WHERE side = 's') AS src_rows,
         count(*) FILTER (WHERE side = 'd') AS dest_rows, count(DISTINCT body) AS bodies
  FROM (SELECT o_orderkey, 's' AS side, o_custkey || '/' || o_totalprice AS body FROM {{orders_seen}}
        UNION ALL
        SELECT o_orderkey, 'd', o_custkey || '/' || o_totalprice FROM {{orders_copied}})
  GROUP BY o_orderkey
) WHERE src_rows <> dest_rows OR bodies > 1"""


@query("row_differences", DIFFERENT.format(columns="""o_orderkey, src_rows, dest_rows,
  CASE WHEN dest_rows = 0 THEN 'missing' WHEN src_rows = 0 THEN 'extra' WHEN dest_rows < src_rows THEN 'lost'
       WHEN dest_rows > src_rows THEN 'doubled' ELSE 'changed' END AS kind"""))
def row_differences(i):
    """Rows that a copy lost, doubled, changed or kept although they are gone, found by checksums."""
    return D.row_differences(i["orders_seen"], i["orders_copied"], ["o_orderkey"], leaf_rows=200)


@query("differing_ranges", DIFFERENT.format(
    columns='o_orderkey AS "first", o_orderkey AS "last", src_rows, dest_rows'))
def differing_ranges(i):
    """The same cut down to ranges of one key each."""
    return D.differing_ranges(
        i["orders_seen"], i["orders_copied"], ["o_orderkey"], fan=16, leaf_rows=1
    )
