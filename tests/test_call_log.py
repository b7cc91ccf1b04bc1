"""Calls to servers that are logged, with reads and writes caught before they leave Spark."""

import re
from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from tablesync.model import TableSpec
from tablesync.operators.ledger import slow_calls
from tablesync.plans.jdbc_copy import Server, copy_between
from tablesync.session import fresh_path
from tablesync.sources import jdbc
from tablesync.sources.call_log import CallLog, read_calls, server_name

NOW = datetime(2024, 6, 1, 12)
SPEC = TableSpec("shop", "orders", ("id",))


class Clock:
    """A clock that a caught call can move on."""

    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now


def levels(calls):
    return {(r["server"], r["kind"]): r["level"] for r in slow_calls(calls).collect()}


def test_slow_and_failing_calls_are_found(spark):
    path, clock = fresh_path(spark, "calls"), Clock()
    assert read_calls(spark, path).count() == 0
    log = CallLog(spark, path, "it's one", clock=clock)

    def takes(seconds, error=None):
        def call():
            clock.now += seconds
            if error:
                raise error
            return seconds
        return call

    assert log.timed("jdbc:mysql://u:p@a/db?password=x", "query", "SELECT 1", takes(6)) == 6
    log.timed("jdbc:mysql://a/db", "exec", "SELECT 1", takes(5))
    for kind in ("exec", "queryrow"):
        with pytest.raises(TimeoutError):
            log.timed("jdbc:mysql://b/db", kind, "x" * 5000, takes(1, TimeoutError("gone")))
    assert log.calls().count() == 4 and log.calls().count() == 4
    assert levels(log.calls()) == {("jdbc:mysql://a/db", "query"): "SLOW",
                                   ("jdbc:mysql://b/db", "exec"): "TIMEOUT/ERROR"}
    other = CallLog(spark, path, "two", buffered=2, clock=clock)
    for seconds in (1, 2, 9):
        other.timed("jdbc:mysql://b/db", "query", "", takes(seconds))
    assert read_calls(spark, path).count() == 6  # the third waits for more
    assert other.calls().count() == 3 and read_calls(spark, path).count() == 7
    longest = read_calls(spark, path).selectExpr("max(length(statement))", "max(error)").first()
    assert tuple(longest) == (2000, "TimeoutError: gone")


@pytest.mark.parametrize("url, name", [
    ("jdbc:mysql://root:se@cr/et@host:3306/db?user=u&password=p", "jdbc:mysql://host:3306/db"),
    ("jdbc:sqlserver://host;user=u;password=p", "jdbc:sqlserver://host"),
    ("jdbc:mysql:src", "jdbc:mysql:src"),
])
def test_no_password_is_logged(url, name):
    assert server_name(url) == name


def test_a_log_that_cannot_be_written_stops_nothing(spark, monkeypatch):
    log = CallLog(spark, fresh_path(spark, "calls"), "run", buffered=1)
    real, log.path = log.path, "nowhere://x"
    assert log.timed("s", "query", "q", lambda: 1) == 1
    log.path = real
    assert log.calls().count() == 1


@pytest.fixture
def tables(spark, monkeypatch):
    """Two servers' tables, as lists of rows."""
    held = {"src": [(n, f"n{n}") for n in range(10)], "dst": []}

    def frame(url, query):
        rows = spark.createDataFrame(held[url.rsplit("/", 1)[1]], "id bigint, name string")
        rows.createOrReplaceTempView("asked")
        return spark.sql(re.sub(r"FROM `.*`\) t", "FROM asked", query).strip("("))

    def write(rows, options, mode):
        held["dst"] += [tuple(r) for r in rows.collect()]

    monkeypatch.setattr(jdbc, "read_jdbc", lambda spark, o: frame(o["url"], o["dbtable"]))
    monkeypatch.setattr(jdbc, "read_jdbc_ranges", lambda spark, url, query, conditions, properties: reduce(
        DataFrame.unionByName, [frame(url, query).filter(c) for c in conditions]))
    monkeypatch.setattr(jdbc, "write_jdbc", write)
    return held


def test_every_call_of_a_copy_is_logged(spark, tables, monkeypatch):
    clock = Clock()
    log = CallLog(spark, fresh_path(spark, "calls"), "run", clock=clock)
    source, dest = Server("x://h/src", 1, wait=0, log=log), Server("x://h/dst", 1, wait=0, log=log)
    copy = lambda: copy_between(spark, source, dest, SPEC, ["id", "name"], NOW, "resume", rows_per_range=5)
    assert copy().first()["verdict"] == "ok" and len(tables["dst"]) == 10
    calls = read_calls(spark, log.path)
    kinds = {(r["server"], r["kind"]): r["count"] for r in calls.groupBy("server", "kind").count().collect()}
    # Counts and marks of both, two ranges read, two written.
    assert kinds == {("x://h/src", "queryrow"): 2, ("x://h/dst", "queryrow"): 2,
                     ("x://h/src", "query"): 2, ("x://h/dst", "exec"): 2}
    assert levels(calls) == {}

    def lost(rows, options, mode):
        clock.now += 7
        raise ConnectionError("lost")

    monkeypatch.setattr(jdbc, "write_jdbc", lost)
    with pytest.raises(ConnectionError):
        copy()
    assert levels(read_calls(spark, log.path)) == {("x://h/dst", "exec"): "TIMEOUT/ERROR"}
