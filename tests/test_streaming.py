from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.operators.ledger import EVENT_SCHEMA, ledger_state
from tablesync.plans.copy import copy_table
from tablesync.session import fresh_path
from tablesync.sources.ledger_store import Ledger
from tablesync.streaming.jobs import (
    BATCH,
    read_files,
    stream_copy,
    stream_ledger,
    write_increments,
)

NOW = datetime(2024, 6, 1, 12, 0, 0)


@pytest.fixture
def folder(spark):
    return fresh_path(spark, "arriving")


def arrive(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_copy_over_several_micro_batches_and_a_restart(spark, folder):
    dest = spark.range(10).select("id", F.lit("old").alias("created_at"), F.lit(0).alias("v"))
    path, checkpoint = fresh_path(spark, "inc"), fresh_path(spark, "ck")
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")

    def run():
        stream = read_files(spark, folder, dest.schema, files_per_trigger=1)
        return stream_copy(stream, dest, ["id"], ["v"], NOW, path, checkpoint, ledger, "s.t")

    arrive(spark.sql("SELECT 3L id, '0000-00-00' created_at, 1 v UNION ALL SELECT 3L, 'x', 2"), folder)
    first = {r["id"]: (r["created_at"], r["v"]) for r in run().collect()}
    assert first[3] == ("x", 2) and len(first) == 10

    arrive(spark.sql("SELECT 3L id, '0000-00-00' created_at, 1 v"), folder)
    arrive(spark.sql("SELECT 20L id, 'new' created_at, 7 v"), folder)
    second = {r["id"]: (r["created_at"], r["v"]) for r in run().collect()}
    # A later micro-batch wins although its order value is lower.
    assert second[3] == ("2024-06-01 12:00:00", 1)
    assert second[20] == ("new", 7) and len(second) == 11
    state = ledger_state(ledger.events()).first()
    assert (state["retry_count"], state["processed_rows"], state["is_completed"]) == (1, 3, True)


def test_a_stream_is_complete_where_its_rows_lie(spark, folder):
    dest = spark.range(3).select("id", F.lit("old").alias("created_at"))
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    arrive(spark.sql("SELECT 7L id, 'new' created_at"), folder)
    stream = read_files(spark, folder, dest.schema)
    stream_copy(stream, dest, ["id"], ["id"], NOW, fresh_path(spark, "inc"), fresh_path(spark, "ck"),
                ledger, "s.t")
    again = copy_table(dest, TableSpec("s", "t", ("id",)), NOW, ledger=ledger)
    assert again.skipped and again.rows == 4 and again.destination.columns == dest.columns


def test_an_error_in_a_stream_is_recorded(spark, folder):
    dest = spark.range(3).select("id", F.lit("old").alias("created_at"))
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    arrive(spark.sql("SELECT 7L id, 'new' created_at"), folder)
    bad = read_files(spark, folder, dest.schema).withColumn(
        "created_at", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        stream_copy(bad, dest, ["id"], ["id"], NOW, fresh_path(spark, "inc"), fresh_path(spark, "ck"),
                    ledger, "s.t")
    state = ledger_state(ledger.events()).first()
    assert "broken" in state["error_message"] and not state["is_completed"]


def test_a_replayed_micro_batch_adds_nothing(spark, folder):
    schema = spark.range(1).schema
    path = fresh_path(spark, "inc")
    arrive(spark.range(5), folder)
    for _ in range(2):  # a new checkpoint makes the second run replay batch 0
        write_increments(read_files(spark, folder, schema), path, fresh_path(spark, "ck"))
    assert spark.read.parquet(path).count() == 5
    assert spark.read.parquet(path).select(BATCH).distinct().count() == 1


def test_ledger_state_over_micro_batches_equals_the_batch_result(spark, folder):
    ops = F.element_at(
        F.array(*[F.lit(o) for o in ("start", "progress", "error", "complete", "progress")]),
        (F.col("id") * 7 % 5 + 1).cast("int"))
    events = spark.range(1, 301).select(
        F.lit("r").alias("run_id"), F.col("id").alias("event_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("t"), F.col("id") % 11).alias("table_key"), ops.alias("op"),
        F.col("id").alias("total_rows"), F.col("id").alias("last_id"),
        F.col("id").alias("processed_rows"), F.concat(F.lit("m"), "id").alias("message"))
    for part in (2, 0, 1):  # not in event order
        arrive(events.filter(F.col("event_id") % 3 == part), folder)
    stream = read_files(spark, folder, EVENT_SCHEMA, files_per_trigger=1)
    found = stream_ledger(stream, fresh_path(spark, "st"), fresh_path(spark, "ck"))
    assert sorted(map(str, found.collect())) == sorted(map(str, ledger_state(events).collect()))
