"""Merged micro-batches, streams without files, and the engine's state of a ledger."""

import math
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.ledger import EVENT_SCHEMA, ledger_state, pending_tables
from tablesync.operators.skew import latest_per_key
from tablesync.session import fresh_path
from tablesync.sources.ledger_store import Ledger
from tablesync.sources.zones import folder_exists
from tablesync.streaming import jobs, levels
from tablesync.streaming.jobs import read_files, stream_copy, stream_ledger, stream_sanitize
from tablesync.streaming.levels import BATCH, FAN, Run, fold_batches, plan_merges, read_runs
from tablesync.streaming.state import FIELDS, add_events, advancing

NOW = datetime(2024, 6, 1, 12)
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType())])


def test_the_thousandth_call_reads_few_runs():
    runs, writes = [], 0
    for n in range(1000):
        kept = []
        for members in plan_merges([*runs, Run(str(n), 0, n, n)]):
            if len(members) == 1:
                kept += members
            else:
                writes += members[-1].last - members[0].first + 1
                kept.append(Run("m", levels._level(members, FAN), members[0].first, members[-1].last))
        runs = kept
        assert [r.first for r in runs[1:]] == [r.last + 1 for r in runs[:-1]]
        assert len(runs) <= (FAN - 1) * (1 + math.log(n + 1, FAN))
    assert writes <= 1000 * math.log(1000, FAN)
    # All at once is as good as one by one.
    assert len(plan_merges([Run(str(n), 0, n, n) for n in range(1000)])) <= len(runs)


def test_merged_batches_hold_the_last_row_of_every_key(spark):
    path, rng = fresh_path(spark, "inc"), random.Random(2)
    last = lambda rows: latest_per_key(rows, ["id"], [BATCH])
    wanted = {}
    for n in range(11):
        rows = [(k, rng.randrange(10**6)) for k in rng.sample(range(30), 6)]
        wanted |= dict(rows)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{BATCH}={n}")
        runs = fold_batches(spark, path, SCHEMA, last)
        assert len(runs) <= 2 * FAN and runs[-1].last == n
    assert {r["id"]: r["v"] for r in last(read_runs(spark, path, SCHEMA, runs)).collect()} == wanted
    assert fold_batches(spark, path, SCHEMA, last) == runs  # nothing new, nothing written
    # Micro-batches that were merged long ago are gone, and the runs are all there is to read.
    assert not folder_exists(spark, f"{path}/{BATCH}=0")
    assert all(folder_exists(spark, run.folder) for run in runs)


def test_streams_of_folders_without_files(spark):
    folder = fresh_path(spark, "nothing")
    spark.range(0).select("id", F.col("id").alias("v")).write.parquet(folder)
    system = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for file in system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder)):
        system.delete(file.getPath(), False)
    dest = spark.createDataFrame([(1, 10), (2, 20)], SCHEMA)
    fresh = lambda label: fresh_path(spark, label)
    stream = read_files(spark, folder, SCHEMA)
    copied = stream_copy(stream, dest, ["id"], ["v"], NOW, fresh("inc"), fresh("ck"))
    assert sorted(map(tuple, copied.collect())) == [(1, 10), (2, 20)]
    assert stream_sanitize(stream, NOW, fresh("inc"), fresh("ck")).collect() == []
    events = read_files(spark, folder, EVENT_SCHEMA)
    assert stream_ledger(events, fresh("inc"), fresh("ck")).collect() == []


def test_a_streamed_key_that_breaks_the_rules_stays(spark):
    folder = fresh_path(spark, "in")
    schema = T.StructType.fromDDL("created_at string, v bigint")
    dest = spark.createDataFrame([("0000-00-00", 1), ("b", 2)], schema)
    spark.createDataFrame([("0000-00-00", 5)], schema).write.parquet(folder)
    stream = read_files(spark, folder, schema)
    for _ in range(2):
        got = stream_copy(stream, dest, ["created_at"], ["v"], NOW, fresh_path(spark, "inc"), fresh_path(spark, "ck"))
        assert sorted(map(tuple, got.collect())) == [("0000-00-00", 5), ("b", 2)]


def random_events(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    ops = ["start", "progress", "progress", "error", "complete", "recount"]
    base = 7 * 10**18  # beyond what a floating-point number tells apart
    return [
        ("r" if n % 5 else "q", base + n, datetime(2024, 1, 1), rng.choice(["a", "b", "c", "d", None]), rng.choice(ops),
         *(rng.choice([None, 2**62 + n]) for _ in range(3)), rng.choice([None, f"m{n}"]))
        for n in range(240)
    ]


@pytest.mark.parametrize("seed", range(2))
def test_a_ledger_stream_that_is_stopped_and_started_equals_the_fold(spark, seed):
    events = random_events(seed)
    random.Random(seed + 9).shuffle(events)
    folder, path, check = (fresh_path(spark, label) for label in ("in", "st", "ck"))
    frames = [spark.createDataFrame(events[n::4], EVENT_SCHEMA).coalesce(1) for n in range(4)]
    for n in (0, 1, 2, 3):
        frames[n].write.mode("append").parquet(folder)
        if n in (1, 3):  # two runs over the same checkpoint
            found = stream_ledger(read_files(spark, folder, EVENT_SCHEMA, 1), path, check)
            wanted = ledger_state(frames[0].unionByName(frames[1]) if n == 1 else spark.createDataFrame(events, EVENT_SCHEMA))
            assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_completed_tables_leave_the_state(spark):
    folder, path, check = (fresh_path(spark, label) for label in ("in", "st", "ck"))

    def arrive(ids, op, at):
        rows = [("r", at * 1000 + n, NOW, f"s.t{n}", op, 5, 5, 5, None) for n in ids]
        spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def kept():
        progress = jobs.write_increments(advancing(read_files(spark, folder, EVENT_SCHEMA, 1)), path, check, "update")
        return progress["stateOperators"][0]["numRowsTotal"]

    arrive(range(40), "start", 1)
    assert kept() == 40
    arrive(range(39), "complete", 2)
    assert kept() == 1
    for round_ in range(3):  # further tables come and go
        arrive(range(100, 120), "start", 3 + 2 * round_)
        arrive(range(100, 120), "complete", 4 + 2 * round_)
        assert kept() == 1


def test_a_table_of_the_ledger_stream_costs_python_few_columns(spark):
    """Each column of a group is a data frame of its own in Python, however few events the group has."""
    folder, path, check = (fresh_path(spark, label) for label in ("in", "st", "ck"))
    texts = ['a "b" \\ c', "line\nend\t\x00", "São 😀", "", "null", None]
    events = [
        (run, 2**62 + 10 * n + at, NOW, f"{text}.t", op, *[None if at else 2**62 + n] * 3, text)
        for run in ("r", None) for n, text in enumerate(texts)
        for at, op in enumerate(("start", "error", "complete", "error"))
    ]
    frame = spark.createDataFrame(events, EVENT_SCHEMA)
    frame.coalesce(1).write.parquet(folder)
    stream = read_files(spark, folder, EVENT_SCHEMA)
    plan = advancing(stream)._jdf.queryExecution().analyzed().toString()
    (node,) = [line for line in plan.split("\n") if "FlatMapGroupsInPandasWithState" in line]
    assert len(set(re.findall(r"\w+#\d+", node.split(", obj#")[0]))) <= 5
    found = stream_ledger(stream, path, check)
    assert sorted(map(str, found.collect())) == sorted(map(str, ledger_state(frame).collect()))


def test_adding_events_in_any_order_is_the_same():
    rows = [dict(zip(EVENT_SCHEMA.names, row)) for row in random_events(4) if row[3] == "a"]
    once = add_events(None, iter(rows))
    mixed = rows[1:]
    random.Random(1).shuffle(mixed)
    twice = add_events(add_events(None, iter([rows[0], *mixed[:9]])), iter(mixed[9:]))
    assert once == twice and list(once) == FIELDS


def test_every_table_is_pending_before_the_first_event(spark):
    inventory = spark.createDataFrame([("s.a",), ("s.b",)], "table_key string")
    none = spark.createDataFrame([], EVENT_SCHEMA)
    rows = pending_tables(inventory, none).collect()
    assert sorted((r["run_id"], r["table_key"]) for r in rows) == [(None, "s.a"), (None, "s.b")]
    assert {r["run_id"] for r in pending_tables(inventory, none, "now").collect()} == {"now"}
    fresh = Ledger(spark, fresh_path(spark, "ledger"), "run")
    assert pending_tables(inventory, fresh.events()).count() == 2
