"""The append-only ledger of a run, folded on read to the current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tablesync.functions.measures import bar, percent
from tablesync.operators.reconcile import seconds_between

EVENT_SCHEMA = (
    T.StructType()
    .add("run_id", T.StringType())
    .add("event_id", T.LongType())
    .add("ts", T.TimestampNTZType())
    .add("table_key", T.StringType())
    .add("op", T.StringType())
    .add("total_rows", T.LongType())
    .add("last_id", T.LongType())
    .add("processed_rows", T.LongType())
    .add("message", T.StringType())
)
# How often progress is saved, and when a call is slow.
SAVE_EVERY = 1000
SLOW_SECONDS = 5.0

RUN_TABLE = ["run_id", "table_key"]


def _id_of(ops: list[str]) -> Column:
    return F.when(F.col("op").isin(*ops), F.col("event_id"))


def fold(events: DataFrame) -> DataFrame:
    """What the events of each table add up to.

    One group-by of minima, maxima and values at the largest event id: it is
    summed up per task before the shuffle, gives the same answer in any
    arrival order and also runs on a stream.
    """
    start, complete, error = _id_of(["start"]), _id_of(["complete"]), _id_of(["error"])
    moved, progress = _id_of(["progress", "error"]), _id_of(["progress"])
    counted = _id_of(["start", "recount"])
    return events.groupBy(*RUN_TABLE).agg(
        F.count(start).alias("starts"),
        F.count(complete).alias("completes"),
        F.count(error).alias("errors"),
        F.min(start).alias("first_start"),
        F.max(start).alias("last_start"),
        F.max(complete).alias("last_complete"),
        F.max(error).alias("last_error"),
        F.max(moved).alias("last_move"),
        F.max(progress).alias("last_progress"),
        F.max(counted).alias("last_counted"),
        F.max_by("total_rows", counted).alias("counted_rows"),
        F.max_by("last_id", moved).alias("moved_id"),
        F.max_by("processed_rows", progress).alias("progress_rows"),
        F.max_by("message", error).alias("error_text"),
        F.max_by("message", complete).alias("complete_text"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def merge_folds(parts: DataFrame) -> DataFrame:
    """What several folds of a table's events add up to; the parts share no event."""
    totals = [F.sum(c).alias(c) for c in ("starts", "completes", "errors")]
    latest = ("last_start", "last_complete", "last_error", "last_move", "last_progress", "last_counted")
    values = {
        "counted_rows": "last_counted", "moved_id": "last_move", "progress_rows": "last_progress",
        "error_text": "last_error", "complete_text": "last_complete",
    }
    return parts.groupBy(*RUN_TABLE).agg(
        *totals, F.min("first_start").alias("first_start"), *[F.max(c).alias(c) for c in latest],
        *[F.max_by(value, at).alias(value) for value, at in values.items()],
    )


def state_of(folded: DataFrame) -> DataFrame:
    """The state of each table from the fold: a value counts if it came late enough."""
    after_first = lambda event, value: F.when(F.col(event) > F.col("first_start"), F.col(value))
    return folded.filter(F.col("table_key").isNotNull()).select(
        *RUN_TABLE,
        F.when(F.col("starts") > 0, F.col("counted_rows")).alias("total_rows"),
        after_first("last_move", "moved_id").alias("last_id"),
        after_first("last_progress", "progress_rows").alias("processed_rows"),
        F.when(F.col("starts") > 0, F.col("starts") - 1).alias("retry_count"),
        F.when(F.col("last_error") > F.col("last_start"), F.col("error_text")).alias(
            "error_message"
        ),
        F.coalesce(F.col("last_complete") > F.col("last_start"), F.lit(False)).alias(
            "is_completed"
        ),
        (F.col("completes") > 0).alias("ever_completed"),
    )


def ledger_state(events: DataFrame) -> DataFrame:
    """Current state of each table of each run."""
    return state_of(fold(events))


def ledger_summary(events: DataFrame) -> DataFrame:
    """Totals of each run, from one fold of its events."""
    totals = (
        events.filter(F.col("op") == "set_totals")
        .groupBy("run_id")
        .agg(F.max_by("total_rows", "event_id").alias("total_tables"))
    )
    schemas = (
        fold(events)
        .groupBy("run_id", F.substring_index("table_key", ".", 1).alias("schema_name"))
        .agg(
            F.count("table_key").alias("tables"),
            F.count_if(F.col("completes") > 0).alias("completed"),
            F.sum("completes").alias("completes"),
            F.sum("errors").alias("errors"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
        )
    )
    runs = schemas.groupBy("run_id").agg(
        F.count("schema_name").alias("schemas_seen"),
        F.sum("tables").alias("tables_seen"),
        F.sum("completed").alias("completed_tables"),
        F.sum("completes").alias("complete_events"),
        F.sum("errors").alias("error_count"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )
    total = F.coalesce("total_tables", "tables_seen")
    return runs.join(totals, "run_id", "left").select(
        "run_id",
        "schemas_seen",
        total.alias("total_tables"),
        "completed_tables",
        (total - F.col("completed_tables")).alias("open_tables"),
        "complete_events",
        "error_count",
        F.round(seconds_between(F.col("first_ts"), F.col("last_ts")), 0).alias("seconds"),
    )


def run_progress(events: DataFrame, width: int = 40) -> DataFrame:
    """Tables done, percentage and bar after each table a run completed first.

    The window runs over completed tables, one row each, not over events.
    """
    first = (
        events.filter((F.col("op") == "complete") & F.col("table_key").isNotNull())
        .groupBy(*RUN_TABLE)
        .agg(F.min("event_id").alias("event_id"))
    )
    done = F.row_number().over(W.partitionBy("run_id").orderBy("event_id")).cast("bigint")
    totals = ledger_summary(events).select("run_id", "total_tables")
    share = F.col("done").cast("double") / F.col("total_tables") * 100
    return (
        first.withColumn("done", done)
        .join(totals, "run_id")
        .select(
            *RUN_TABLE,
            "done",
            "total_tables",
            percent(F.col("done"), F.col("total_tables")).alias("percent"),
            bar(share, width, full="█").alias("bar"),
        )
    )


def ledger_errors(state: DataFrame) -> DataFrame:
    """Tables whose state holds an error text."""
    return state.filter(F.col("error_message") != "").select(*RUN_TABLE, "error_message")


def retry_counts(events: DataFrame) -> DataFrame:
    """Attempts after the first, per started table."""
    return (
        events.filter(F.col("op") == "start")
        .groupBy(*RUN_TABLE)
        .agg((F.count(F.lit(1)) - 1).alias("retry_count"))
    )


def pending_tables(
    inventory: DataFrame, events: DataFrame, run_id: str | None = None
) -> DataFrame:
    """Per run the tables of the inventory that it has not completed; of all runs or of one.

    A run is named by its events; the names, one short row per run, reach the
    driver and are laid beside each table. Before the first event every table is pending, once, without
    a run.
    """
    if run_id is None:
        named = events.filter(F.col("run_id").isNotNull()).select("run_id").distinct()
        runs = [row["run_id"] for row in named.collect()] or [None]
    else:
        runs = [run_id]
    listed = F.explode(F.array(*[F.lit(run) for run in runs]).cast("array<string>"))
    done = events.filter(F.col("op") == "complete").select(*RUN_TABLE).distinct()
    return inventory.withColumn("run_id", listed).join(done, RUN_TABLE, "left_anti").select(
        "run_id", *inventory.columns
    )


def resume_point(
    inventory: DataFrame, dest_marks: DataFrame, state: DataFrame, run_id: str | None = None
) -> DataFrame:
    """After which key each table goes on, and where that was learned.

    One row per table and run that knows it, or per table for the one run
    named; a table that no run knows has a row without a run. ``dest_marks`` has a row for each destination that could be read, with a
    NULL mark for an empty one. The ledger decides only where there is none;
    a ledger ahead of the destination is flagged.
    """
    marks = dest_marks.withColumn("_readable", F.lit(True))
    if run_id is not None:
        state = state.filter(F.col("run_id") == run_id)
    known = state.select(*RUN_TABLE, F.col("last_id").alias("ledger_mark"))
    readable = F.coalesce("_readable", F.lit(False))
    return (
        inventory.join(marks, "table_key", "left")
        .join(known, "table_key", "left")
        .select(
            *RUN_TABLE,
            "dest_mark",
            "ledger_mark",
            F.when(readable, F.col("dest_mark")).otherwise(F.col("ledger_mark")).alias(
                "resume_after"
            ),
            F.when(readable, "destination")
            .when(F.col("ledger_mark").isNotNull(), "ledger")
            .otherwise("none")
            .alias("learned_from"),
            F.coalesce(
                readable
                & (F.col("dest_mark").isNull() | (F.col("ledger_mark") > F.col("dest_mark")))
                & F.col("ledger_mark").isNotNull(),
                F.lit(False),
            ).alias("ledger_ahead"),
        )
    )


def drift_recount(source_counts: DataFrame, state: DataFrame) -> DataFrame:
    """Tables of the ledger with the count taken now; the corrected total is the new one."""
    return state.join(source_counts, "table_key").select(
        *RUN_TABLE,
        F.col("total_rows").alias("ledger_total"),
        F.col("total_records").alias("now_rows"),
        (~F.col("total_rows").eqNullSafe(F.col("total_records"))).alias("changed"),
    )


def corrected_state(state: DataFrame, drift: DataFrame) -> DataFrame:
    """The state with the counts taken now, where ``drift_recount`` has one."""
    now = drift.select(*RUN_TABLE, "now_rows")
    return state.join(now, RUN_TABLE, "left").select(
        *[F.coalesce("now_rows", "total_rows").alias(c) if c == "total_rows" else F.col(c)
          for c in state.columns]
    )


def empty_tables(counts: DataFrame) -> DataFrame:
    """Tables to complete without copying a row."""
    return counts.filter(F.col("total_records") == 0)


def save_points(events: DataFrame, every: int = SAVE_EVERY) -> DataFrame:
    """Progress events at a multiple of ``every`` processed rows."""
    return events.filter((F.col("op") == "progress") & (F.col("processed_rows") % every == 0))


def slow_calls(calls: DataFrame, slow_seconds: float = SLOW_SECONDS) -> DataFrame:
    """Calls worth a log line: failed, or slower than the limit.

    A single-row call hands its error on to the row, so it can only be slow.
    """
    failed = F.col("error").isNotNull() & (F.col("kind") != "queryrow")
    level = F.when(failed, "TIMEOUT/ERROR").when(F.col("duration") > slow_seconds, "SLOW")
    return calls.withColumn("level", level).filter(F.col("level").isNotNull())
