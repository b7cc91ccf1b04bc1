"""The ledger as an append-only Parquet table."""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.ledger import EVENT_SCHEMA, drift_recount, ledger_state
from tablesync.session import remove_folder

EVENT_KEY = ["run_id", "event_id", "table_key", "op"]
WRITER_BITS = 12


def append_events(events: DataFrame, path: str) -> None:
    """Add events in a folder of their own, so that writers never touch each other's files."""
    events.write.parquet(f"{path}/{uuid.uuid4().hex}")


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All events ever added."""
    reader = spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(*([path] if isinstance(path, str) else path))


def _event(values: Sequence) -> list[Column]:
    return [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, EVENT_SCHEMA)]


OWNER = "_compacting"


def compact_events(spark: SparkSession, path: str, keep_seconds: int = 3600) -> int:
    """Bring the events of older folders into one; returns how many folders were brought in.

    One run at a time compacts a ledger: the one whose file names it as the
    owner; others leave at once. A folder that was brought in goes only
    ``keep_seconds`` later, at a further compaction, so a run that has listed it still reads it.
    ``Ledger.events`` counts an event once, so a stop in between loses and
    doubles nothing. Events that are added meanwhile stay in their own folders.
    """
    files = spark._jvm.org.apache.hadoop.fs
    place = files.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    owner = files.Path(place, OWNER)
    try:
        system.create(owner, False).close()  # fails if it is there
    except Exception:
        status = system.getFileStatus(owner) if system.exists(owner) else None
        if status and time.time() - status.getModificationTime() / 1000 < keep_seconds:
            return 0
        system.delete(owner, False)  # its run was lost long ago
        return compact_events(spark, path, keep_seconds)
    try:
        listed = [f for f in system.listStatus(place) if f.isDirectory()]
        marks = {f.getPath().getName() for f in system.listStatus(place) if not f.isDirectory()}
        gone = [f for f in listed if f"_done-{f.getPath().getName()}" in marks]
        for folder in gone:
            mark = files.Path(place, f"_done-{folder.getPath().getName()}")
            if time.time() - system.getFileStatus(mark).getModificationTime() / 1000 >= keep_seconds:
                remove_folder(spark, folder.getPath().toString())
                system.delete(mark, False)
        fresh = [f.getPath() for f in listed if f not in gone]
        if len(fresh) < 2:
            return 0
        events = read_events(spark, [f.toString() for f in fresh]).dropDuplicates(EVENT_KEY)
        append_events(events.coalesce(1), path)
        for folder in fresh:
            system.create(files.Path(place, f"_done-{folder.getName()}"), True).close()
        return len(fresh)
    finally:
        system.delete(owner, False)


class Ledger:
    """Events of one run, written as they happen.

    Event ids are microseconds followed by bits of the writer. A writer's ids
    only grow, and begin above all ids it finds, so a clock that runs back does
    not reorder events of runs that follow each other.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id
        # The folder has to be there before the first event is read.
        append_events(spark.range(0).select(*_event([None] * len(EVENT_SCHEMA))), path)
        self._writer = uuid.uuid4().int % (1 << WRITER_BITS)
        self._last = read_events(spark, path).agg(F.max("event_id")).first()[0] or 0
        self._lock = threading.Lock()

    def _next_id(self) -> int:
        with self._lock:  # tables are copied from several threads
            tick = max(time.time_ns() // 1000, (self._last >> WRITER_BITS) + 1)
            self._last = tick << WRITER_BITS | self._writer
            return self._last

    def record(
        self,
        table_key: str | None,
        op: str,
        total_rows: int | None = None,
        last_id: int | None = None,
        processed_rows: int | None = None,
        message: str | None = None,
    ) -> None:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        values = (self.run_id, self._next_id(), now, table_key, op,
                  total_rows, last_id, processed_rows, message)
        append_events(self.spark.range(0, 1, 1, 1).select(*_event(values)), self.path)

    def recount(self, source_counts: DataFrame) -> DataFrame:
        """Take counts of now into the run, one event per table whose count has changed.

        Returns ``drift_recount``. Its changed tables, one short row each, reach
        the driver to get their ids; the events are added in one write.
        """
        drift = drift_recount(source_counts, ledger_state(self.events()))
        changed = drift.filter("changed").select("table_key", "now_rows").collect()
        if changed:
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            rows = [(self.run_id, self._next_id(), now, row["table_key"], "recount",
                     row["now_rows"], None, None, None) for row in changed]
            append_events(self.spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1), self.path)
        return drift

    def events(self) -> DataFrame:
        """This run's events. A resumed run keeps its id; a fresh request takes a new one."""
        own = read_events(self.spark, self.path).filter(F.col("run_id") == self.run_id)
        return own.dropDuplicates(EVENT_KEY)

    def compact(self, keep_seconds: int = 3600) -> int:
        return compact_events(self.spark, self.path, keep_seconds)

    def tidy(self) -> None:
        """Compact, but never let that fail what has been done and recorded."""
        try:
            self.compact()
        except Exception as error:  # the events are as they were
            logging.getLogger(__name__).warning("ledger %s is not compacted: %s", self.path, error)
