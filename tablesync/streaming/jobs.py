"""Resumable jobs over tables that arrive as files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.clean import sanitize_copied, sanitize_rows
from tablesync.operators.counts import whole_number
from tablesync.operators.keyed import replace_into
from tablesync.operators.ledger import RUN_TABLE, merge_folds, state_of
from tablesync.operators.skew import latest_per_key
from tablesync.sources.ledger_store import Ledger
from tablesync.sources.versions import new_folder
from tablesync.streaming.levels import BATCH, fold_batches, listed_batches, read_runs
from tablesync.streaming.state import FOLD_SCHEMA, advancing

STREAM = "stream"


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000
) -> DataFrame:
    """Parquet files of a folder, or of all that a glob matches, as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_increments(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "append",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    after: Callable[[int], None] = lambda batch_id: None,
) -> dict | None:
    """Write each micro-batch to its own folder and run until the input is used up.

    A replayed micro-batch overwrites its own folder, so it adds nothing twice.
    Gives what the engine says of the last micro-batch, if there was one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        after(batch_id)

    query = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return query.lastProgress


def read_increments(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches written so far, with their number; none if no file has arrived yet."""
    if not listed_batches(spark, path):
        return read_runs(spark, path, schema, [])
    numbered = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(numbered).parquet(path)


def stream_copy(
    stream: DataFrame,
    dest: DataFrame,
    keys: list[str],
    order_cols: list[str],
    run_ts: datetime,
    path: str,
    checkpoint: str,
    ledger: Ledger | None = None,
    table_key: str | None = None,
) -> DataFrame:
    """Clean and store arriving rows, then replace them into the destination by key.

    A micro-batch stores its last row per key, keys as they are, and never
    rewrites the destination; the destination is folded once, later micro-batches winning,
    and written to a folder beside the increments. Micro-batches are merged by
    size, so a call reads about as many folders as the logarithm of their number. As long as no file has
    arrived the result is the destination. With a ledger each stored
    micro-batch adds its own rows to the progress, a replayed one nothing; the
    table is complete once its folder is written, and an error is recorded.
    """
    spark = dest.sparkSession
    schema = sanitize_copied(stream, run_ts, keys).schema
    last = lambda rows: latest_per_key(rows, keys, [BATCH, *order_cols])
    try:
        if ledger:
            ledger.record(table_key, "start", message=STREAM)
        write_increments(
            stream,
            path,
            checkpoint,
            prepare=lambda batch: sanitize_copied(latest_per_key(batch, keys, order_cols), run_ts, keys),
            after=_progress(spark, path, schema, keys, ledger, table_key) if ledger else lambda n: None,
        )
        runs = fold_batches(spark, path, schema, last)
        latest = last(read_runs(spark, path, schema, runs))
        folder = new_folder(path.rstrip("/") + "-folded")
        replace_into(dest, latest.select(*dest.columns), keys).write.parquet(folder)
    except Exception as error:
        if ledger:
            ledger.record(table_key, "error", message=str(error))
        raise
    if ledger:
        ledger.record(table_key, "complete", message=folder)
    return spark.read.parquet(folder)


def _progress(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: list[str],
    ledger: Ledger,
    table_key: str | None,
) -> Callable[[int], None]:
    """Adds what a micro-batch stored to the last recorded progress of its table."""
    moved = (F.col("table_key") == table_key) & (F.col("op") == "progress")
    row = ledger.events().filter(moved).orderBy(F.desc("event_id")).first()
    last = {"rows": row["processed_rows"] if row else 0, "mark": row["last_id"] if row else None,
            "batch": row["message"] if row else None}

    def record(batch_id: int) -> None:
        name = f"{BATCH}={batch_id}"
        if last["batch"] == name:
            return
        stored = spark.read.schema(schema).parquet(f"{path}/{name}")
        found = stored.agg(F.count(F.lit(1)), F.max(F.col(keys[0]))).first()
        mark = whole_number(found[1])
        marks = [m for m in (last["mark"], mark) if m is not None]
        last.update(rows=last["rows"] + found[0], mark=max(marks, default=None), batch=name)
        ledger.record(table_key, "progress", last_id=last["mark"], processed_rows=last["rows"],
                      message=name)

    return record


def stream_sanitize(
    stream: DataFrame, run_ts: datetime, path: str, checkpoint: str
) -> DataFrame:
    """The cleaning rules on a stream; they keep no state."""
    clean = sanitize_rows(stream, run_ts)
    write_increments(clean, path, checkpoint)
    return read_increments(stream.sparkSession, path, clean.schema).drop(BATCH)


def stream_ledger(events: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Current state of each table from ledger events as they arrive.

    The engine keeps what the events of each open table add up to and drops it
    when the table is completed; a micro-batch writes only the tables it changed. What
    belongs to a table that goes on after that is added up when it is read.
    """
    spark = events.sparkSession
    schema = T.StructType.fromDDL(FOLD_SCHEMA)
    last = lambda rows: latest_per_key(rows, [*RUN_TABLE, "epoch"], [BATCH])
    write_increments(advancing(events), path, checkpoint, output_mode="update")
    runs = fold_batches(spark, path, schema, last)
    return state_of(merge_folds(last(read_runs(spark, path, schema, runs))))
