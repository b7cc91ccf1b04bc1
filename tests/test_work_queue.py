"""The queue of tables and their pieces: order, retries, failures."""

import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.operators.ledger import ledger_summary
from tablesync.plans.copy import copy_tables, guessed_rows
from tablesync.plans.work_queue import Piece, WorkQueue
from tablesync.session import fresh_path
from tablesync.sources.ledger_store import Ledger
from tablesync.sources.versions import open_table

NOW = datetime(2024, 6, 1, 12)


class Fake:
    """A job of pieces that sleep; ``fails`` says how often its first piece does."""

    def __init__(self, name, pieces, seconds, guess=None, fails=0, opening_fails=0):
        self.name, self.rows, self.fails, self.opening_fails = name, guess or pieces, fails, opening_fails
        self.count, self.seconds, self.done, self.error = pieces, seconds, [], None
        self.finished = 0
        self.lock = threading.Lock()

    def open(self):
        if self.opening_fails:
            self.opening_fails -= 1
            raise RuntimeError("not yet")
        return [Piece(100, lambda n=n: self.piece(n)) for n in range(self.count)]

    def piece(self, n):
        time.sleep(self.seconds)
        with self.lock:
            if n == 0 and self.fails:
                self.fails -= 1
                raise RuntimeError("lost")
            self.done.append((n, time.monotonic()))

    def finish(self):
        self.finished += 1
        return len(self.done)

    def fail(self, error):
        self.error = error


def test_one_huge_and_fifty_small_tables_end_near_the_ideal():
    jobs = [Fake(f"s{n}", 1, 0.03) for n in range(50)] + [Fake("huge", 60, 0.03, guess=10_000)]
    began = time.monotonic()
    assert WorkQueue(None, workers=5).run(jobs) == [1] * 50 + [60]
    assert time.monotonic() - began < 1.3 * (50 + 60) * 0.03 / 5 + 0.1
    assert all(job.finished == 1 for job in jobs)


def test_a_table_that_cannot_be_cut_is_not_left_for_the_end():
    jobs = [Fake(f"s{n}", 1, 0.03) for n in range(30)] + [Fake("long", 1, 0.4, guess=10_000)]
    began = time.monotonic()
    WorkQueue(None, workers=3).run(jobs)
    assert time.monotonic() - began < 1.3 * 0.45 + 0.1


def test_speeds_are_learned():
    """Of two tables that look alike the slower one is worked on first."""
    slow, fast = Fake("slow", 12, 0.05), Fake("fast", 12, 0.005)
    WorkQueue(None, workers=2).run([fast, slow])
    assert len(slow.done) == len(fast.done) == 12
    assert max(t for _, t in slow.done) - min(t for _, t in slow.done) < 12 * 0.05


def test_what_fails_twice_succeeds_the_third_time():
    jobs = [Fake("a", 3, 0.01, fails=2), Fake("b", 2, 0.01, opening_fails=2), Fake("c", 1, 0.01, fails=3)]
    queue = WorkQueue(None, workers=2, wait=0.02)
    a, b, c = queue.run(jobs)
    assert (a, b) == (3, 2) and isinstance(c, RuntimeError)
    assert jobs[2].error is c and jobs[0].error is None and jobs[2].finished == 0
    assert WorkQueue(None, workers=2).run([]) == []


def test_waits_grow_and_others_run_meanwhile():
    bad, other = Fake("bad", 1, 0.0, fails=3), Fake("other", 40, 0.01)
    began = time.monotonic()
    outcome, done = WorkQueue(None, workers=1, wait=0.05).run([bad, other])
    assert isinstance(outcome, RuntimeError) and done == 40
    assert 0.15 <= time.monotonic() - began < 1.5


def test_tables_that_fail_for_a_while_are_copied(spark, monkeypatch):
    from tablesync.plans import copy as plan

    root, ledger = fresh_path(spark, "root"), Ledger(spark, fresh_path(spark, "ledger"), "run")
    specs = [TableSpec("s", n, ("id",)) for n in ("big", "small")]
    sources = {specs[0]: spark.range(900), specs[1]: spark.range(30)}
    assert guessed_rows(sources[specs[0]]) > guessed_rows(sources[specs[1]])
    write, failures = plan.rows_to_write, {"left": 2}

    def shaky(*args):
        if failures["left"]:
            failures["left"] -= 1
            raise RuntimeError("connection lost")
        return write(*args)

    monkeypatch.setattr(plan, "rows_to_write", shaky)
    report, results = copy_tables(spark, sources, NOW, ledger=ledger, root=root, rows_per_range=100, wait=0.05)
    assert {r["table_name"]: (r["status"], r["rows"]) for r in report.collect()} == {
        "big": ("COMPLETED", 900), "small": ("COMPLETED", 30)}
    assert sorted(r["id"] for r in open_table(spark, root, specs[0]).collect()) == list(range(900))
    progress = ledger.events().filter("table_key = 's.big' AND op = 'progress'").orderBy("event_id").collect()
    assert [r["processed_rows"] for r in progress] == list(range(100, 1000, 100))  # in key order
    assert ledger_summary(ledger.events()).first()["error_count"] == 0


def test_a_range_that_never_succeeds_keeps_what_lies_before_it(spark):
    root, ledger = fresh_path(spark, "root"), Ledger(spark, fresh_path(spark, "ledger"), "run")
    spec, good = TableSpec("s", "t", ("id",)), spark.range(100).withColumn("v", F.col("id"))
    bad = good.withColumn("v", F.when(F.col("id") == 55, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("v")))
    options = dict(ledger=ledger, root=root, rows_per_range=10, wait=0.01)
    report, _ = copy_tables(spark, {spec: bad}, NOW, **options)
    row = report.first()
    assert row["status"] == "FAILED" and "lost" in row["error"]
    assert ledger.events().filter("op = 'progress'").count() == 5
    report, results = copy_tables(spark, {spec: good}, NOW, **options)
    assert report.first()["status"] == "COMPLETED" and len(results[spec].locations) == 10
    assert sorted(r["v"] for r in results[spec].destination.collect()) == list(range(100))
    with pytest.raises(ValueError):
        copy_tables(spark, {spec: good}, NOW, mode="merge")
