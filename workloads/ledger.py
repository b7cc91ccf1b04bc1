"""Ledger queries. The checking SQL finds each state by ordered windows, not by a fold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators import ledger as L
from tablesync.session import fresh_path
from tablesync.sources.ledger_store import append_events, read_events
from workloads.registry import query


def state_sql(events: str) -> str:
    """State per run and table: for each value, the last event that may set it."""
    return f"""
SELECT run_id, table_key,
       arg_max(total_rows, event_id) FILTER (op = 'start') AS total_rows,
       arg_max(last_id, event_id) FILTER (op IN ('progress', 'error') AND event_id > fs) AS last_id,
       arg_max(processed_rows, event_id) FILTER (op = 'progress' AND event_id > fs)
         AS processed_rows,
       CASE WHEN count(*) FILTER (op = 'start') > 0
            THEN count(*) FILTER (op = 'start') - 1 END AS retry_count,
       arg_max(message, event_id) FILTER (op = 'error' AND event_id > ls) AS error_message,
       count(*) FILTER (op = 'complete' AND event_id > ls) > 0 AS is_completed,
       count(*) FILTER (op = 'complete') > 0 AS ever_completed
FROM (SELECT *, min(CASE WHEN op = 'start' THEN event_id END) OVER w AS fs,
             max(CASE WHEN op = 'start' THEN event_id END) OVER w AS ls
      FROM {{{events}}} WINDOW w AS (PARTITION BY run_id, table_key))
GROUP BY run_id, table_key"""


STATE_SQL = state_sql("ledger_events")


@query("ledger_state", STATE_SQL)
def ledger_state(i):
    return L.ledger_state(i["ledger_events"])


@query("ledger_roundtrip", STATE_SQL)
def ledger_roundtrip(i):
    """The events are appended in parts, in no order, and folded from what was stored."""
    path = fresh_path(i.spark, "ledger")
    events = i["ledger_events"]
    for part in range(3):
        append_events(events.filter(F.pmod("event_id", F.lit(3)) == part), path)
    return L.ledger_state(read_events(i.spark, path))


@query("ledger_summary", """
SELECT run_id, count(DISTINCT split_part(table_key, '.', 1)) AS schemas_seen,
       arg_max(total_rows, event_id) FILTER (op = 'set_totals') AS total_tables,
       count(DISTINCT table_key) FILTER (op = 'complete') AS completed_tables,
       arg_max(total_rows, event_id) FILTER (op = 'set_totals')
         - count(DISTINCT table_key) FILTER (op = 'complete') AS open_tables,
       count(*) FILTER (op = 'complete') AS complete_events,
       count(*) FILTER (op = 'error') AS error_count,
       round(date_diff('microsecond', min(ts), max(ts)) / 1e6, 0) AS seconds
FROM {ledger_with_totals} GROUP BY run_id""")
def ledger_summary(i):
    return L.ledger_summary(i["ledger_with_totals"])


@query("run_progress", """
SELECT run_id, table_key, done, total_tables,
       round(CAST(done AS DOUBLE) / total_tables * 100, 1) AS percent,
       '[' || repeat('█', CAST(floor(done / total_tables * 100 / 100 * 40) AS BIGINT))
           || repeat('░', 40 - CAST(floor(done / total_tables * 100 / 100 * 40) AS BIGINT))
           || ']' AS bar
FROM (SELECT c.run_id, c.table_key, t.total_tables,
             row_number() OVER (PARTITION BY c.run_id ORDER BY min(c.event_id)) AS done
      FROM {ledger_with_totals} c
      JOIN (SELECT run_id, total_rows AS total_tables FROM {ledger_with_totals}
            WHERE op = 'set_totals') t ON c.run_id = t.run_id
      WHERE c.op = 'complete' GROUP BY c.run_id, c.table_key, t.total_tables)""")
def run_progress(i):
    return L.run_progress(i["ledger_with_totals"])


@query("ledger_errors", f"""
SELECT run_id, table_key, error_message FROM ({STATE_SQL}) WHERE error_message IS NOT NULL""")
def ledger_errors(i):
    return L.ledger_errors(ledger_state(i))


@query("retry_counts", """
SELECT run_id, table_key, max(attempt) - 1 AS retry_count
FROM (SELECT run_id, table_key,
             row_number() OVER (PARTITION BY run_id, table_key ORDER BY event_id) AS attempt
      FROM {ledger_events} WHERE op = 'start')
GROUP BY run_id, table_key""")
def retry_counts(i):
    return L.retry_counts(i["ledger_events"])


@query("pending_tables", """
SELECT r.run_id, t.table_key, t.total_records
FROM {ledger_tables} t, (SELECT DISTINCT run_id FROM {ledger_events}) r
WHERE NOT EXISTS (SELECT 1 FROM {ledger_events} e WHERE e.op = 'complete'
                  AND e.run_id = r.run_id AND e.table_key = t.table_key)""")
def pending_tables(i):
    return L.pending_tables(i["ledger_tables"], i["ledger_events"])


@query("resume_point", f"""
SELECT s.run_id, t.table_key, d.dest_mark, s.last_id AS ledger_mark,
       CASE WHEN d.table_key IS NOT NULL THEN d.dest_mark ELSE s.last_id END AS resume_after,
       CASE WHEN d.table_key IS NOT NULL THEN 'destination'
            WHEN s.last_id IS NOT NULL THEN 'ledger' ELSE 'none' END AS learned_from,
       d.table_key IS NOT NULL AND s.last_id IS NOT NULL
         AND (d.dest_mark IS NULL OR s.last_id > d.dest_mark) AS ledger_ahead
FROM {{ledger_tables}} t
LEFT JOIN {{dest_marks}} d ON t.table_key = d.table_key
LEFT JOIN ({STATE_SQL}) s ON t.table_key = s.table_key""")
def resume_point(i):
    state = L.ledger_state(i["ledger_events"])
    return L.resume_point(i["ledger_tables"].select("table_key"), i["dest_marks"], state)


@query("drift_recount", f"""
SELECT s.run_id, s.table_key, s.total_rows AS ledger_total, t.total_records AS now_rows,
       s.total_rows IS DISTINCT FROM t.total_records AS changed
FROM ({STATE_SQL}) s JOIN {{ledger_tables}} t ON s.table_key = t.table_key""")
def drift_recount(i):
    return L.drift_recount(i["ledger_tables"], ledger_state(i))


@query("corrected_state", f"""
SELECT s.run_id, s.table_key, coalesce(t.total_records, s.total_rows) AS total_rows, s.last_id,
       s.processed_rows, s.retry_count, s.error_message, s.is_completed, s.ever_completed
FROM ({STATE_SQL}) s LEFT JOIN {{ledger_tables}} t ON s.table_key = t.table_key""")
def corrected_state(i):
    state = ledger_state(i)
    return L.corrected_state(state, L.drift_recount(i["ledger_tables"], state))


@query("empty_tables", "SELECT * FROM {ledger_tables} WHERE total_records = 0")
def empty_tables(i):
    return L.empty_tables(i["ledger_tables"])


@query("save_points", """
SELECT run_id, event_id, table_key, processed_rows FROM {ledger_events}
WHERE op = 'progress' AND processed_rows % 1000 = 0""")
def save_points(i):
    saved = L.save_points(i["ledger_events"])
    return saved.select("run_id", "event_id", "table_key", "processed_rows")


@query("slow_calls", """
SELECT server, kind, level, count(*) AS calls, max(duration) AS longest
FROM (SELECT *, CASE WHEN error IS NOT NULL AND kind <> 'queryrow' THEN 'TIMEOUT/ERROR'
                     WHEN duration > 5 THEN 'SLOW' END AS level FROM {call_log})
WHERE level IS NOT NULL GROUP BY server, kind, level""")
def slow_calls(i):
    return (
        L.slow_calls(i["call_log"])
        .groupBy("server", "kind", "level")
        .agg(F.count(F.lit(1)).alias("calls"), F.max("duration").alias("longest"))
    )
