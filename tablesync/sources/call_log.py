"""A log of the calls to servers: how long each took, and what went wrong."""

from __future__ import annotations

import logging
import re
import threading
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.sources.zones import folder_exists

CALL_SCHEMA = (
    "run_id string, call_id string, server string, kind string, started_at timestamp_ntz, "
    "duration double, error string, statement string"
)
# One call's words in the log; a statement can name as many columns as a table has.
STATEMENT_LENGTH = 2000
BUFFERED_CALLS = 1000

Result = TypeVar("Result")


def server_name(url: str) -> str:
    """A server's address without what a log must not hold: user names, passwords, options."""
    return re.split(r"[?;]", re.sub(r"//.*@", "//", url))[0]


class CallLog:
    """Calls of one run, kept until there are many or someone asks, then written in one folder.

    Calls come from several threads. A call that fails is logged and its error
    goes on to the caller. A log that cannot be written never fails a copy: its
    calls stay and are written with the next ones.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str, buffered: int = BUFFERED_CALLS,
                 clock: Callable[[], float] = time.monotonic):
        self.spark, self.path, self.run_id = spark, path, run_id
        self.buffered, self.clock = buffered, clock
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def timed(self, url: str, kind: str, statement: str, call: Callable[[], Result]) -> Result:
        """What ``call`` gives. ``kind`` is query, queryrow or exec."""
        started, begin, error = datetime.now(timezone.utc).replace(tzinfo=None), self.clock(), None
        try:
            return call()
        except Exception as failure:
            error = f"{type(failure).__name__}: {failure}"[:STATEMENT_LENGTH]
            raise
        finally:
            row = (self.run_id, uuid.uuid4().hex, server_name(url), kind, started,
                   float(self.clock() - begin), error, statement[:STATEMENT_LENGTH])
            with self._lock:
                self._rows.append(row)
                full = len(self._rows) >= self.buffered
            if full:
                self.flush()

    def flush(self) -> None:
        """Write the calls that are not written yet."""
        with self._lock:
            rows, self._rows = self._rows, []
        if not rows:
            return
        try:
            frame = self.spark.createDataFrame(rows, CALL_SCHEMA).coalesce(1)
            frame.write.parquet(f"{self.path}/{uuid.uuid4().hex}")
        except Exception as error:  # a folder without its end is not read, and call ids tell rows apart
            logging.getLogger(__name__).warning("call log %s is not written: %s", self.path, error)
            with self._lock:
                self._rows = rows + self._rows

    def calls(self) -> DataFrame:
        """All calls of this run so far, those of this object included."""
        self.flush()
        return read_calls(self.spark, self.path).filter(F.col("run_id") == self.run_id)


def read_calls(spark: SparkSession, path: str) -> DataFrame:
    """The calls that all runs have logged at ``path``, each once; none if nothing was written yet."""
    if not folder_exists(spark, path):
        return spark.createDataFrame([], CALL_SCHEMA)
    reader = spark.read.schema(CALL_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(path).dropDuplicates(["call_id"])
