"""Copying one table, and many at once."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.operators.clean import odd_key, sanitize_copied, sanitize_rows
from tablesync.operators.conform import conform_rows
from tablesync.operators.counts import mark_value, whole_number
from tablesync.operators.keyed import replace_into
from tablesync.operators.paging import batch_plan, keyset_filter
from tablesync.operators.reconcile import count_check
from tablesync.plans.work_queue import Piece, WorkQueue
from tablesync.session import fresh_path, remove_folder
from tablesync.sources.ledger_store import Ledger
from tablesync.sources.records import read_record
from tablesync.sources.versions import current_folders, new_folder, publish, table_path
from tablesync.sources.zones import clustered, file_count, key_range, sorted_zones, zone_map

MODES = ("full", "resume")


@dataclass(frozen=True)
class CopyResult:
    """The folders a copied table lies in, its rows, and the verdict on its counts.

    ``odd_keys`` are written rows with a key that the cleaning rules would change; keys stay as
    they are.
    """

    locations: tuple[str, ...]
    destination: DataFrame
    rows: int
    verdict: DataFrame | None
    skipped: bool = False
    odd_keys: int = 0


def completed_locations(
    ledger: Ledger | None, specs: Sequence[TableSpec]
) -> dict[str, tuple[str, ...]]:
    """Where the ledger says finished tables lie: one look, one row per finished table."""
    if ledger is None:
        return {}
    rows = (
        ledger.events()
        .filter((F.col("op") == "complete") & F.col("table_key").isin([s.table_key for s in specs]))
        .groupBy("table_key")
        .agg(F.max_by("message", "event_id").alias("message"))
        .collect()
    )
    return {row["table_key"]: tuple(row["message"].split("\n")) for row in rows}


def finished_copy(spark: SparkSession, locations: tuple[str, ...]) -> CopyResult:
    finished = spark.read.parquet(*locations)
    return CopyResult(locations, finished, finished.count(), None, skipped=True)


def guessed_rows(df: DataFrame) -> int:
    """About how many rows a frame has, from what the plan says of its bytes; nothing is read."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    width = sum(20 if kind in ("string", "binary") else 8 for _, kind in df.dtypes)
    return min(size // max(1, width), 1 << 60)


def rows_to_write(
    source: DataFrame, dest: DataFrame | None, keys: list[str], run_ts: datetime
) -> DataFrame:
    """The cleaned rows a copy has to write, given the destination rows they replace."""
    if not keys:
        return sanitize_rows(source, run_ts)
    if dest is None:
        return sanitize_copied(source, run_ts, keys)
    return replace_into(dest, sanitize_copied(source.select(*dest.columns), run_ts, keys), keys)


@dataclass(frozen=True)
class Attempt:
    """What an unfinished copy of this run has written, and whether only its end is missing."""

    folders: tuple[str, ...] = ()
    rows: int = 0
    all_written: bool = False


def unfinished(ledger: Ledger | None, spec: TableSpec, mode: str) -> Attempt:
    """The ranges that this run wrote of a table without completing it, in order."""
    if ledger is None:
        return Attempt()
    events = ledger.events().filter(F.col("table_key") == spec.table_key)
    rows = (
        events.filter(F.col("op").isin("start", "progress", "complete"))
        .orderBy("event_id").select("op", "message", "processed_rows").collect()
    )  # a start, and one row per range
    folders: list[str] = []
    done, final = 0, False
    for row in rows:
        if row["op"] == "complete" or (row["op"] == "start" and row["message"] != mode):
            folders, done, final = [], 0, False
        elif row["op"] == "progress" and row["message"]:
            folder, *end = row["message"].split("\n")
            folders.append(folder)
            done, final = row["processed_rows"], bool(end)
    return Attempt(tuple(folders), done, final)


def copy_table(
    source: DataFrame,
    spec: TableSpec,
    run_ts: datetime,
    locations: Sequence[str] = (),
    mode: str = "full",
    ledger: Ledger | None = None,
    source_rows: int | None = None,
    root: str | None = None,
    rows_per_range: int | None = None,
) -> CopyResult:
    """Bring a table in line with ``source``: the one below ``root``, or in ``locations``.

    ``full`` replaces by key with the whole cleaned source and writes the
    result anew. ``resume`` adds the cleaned rows above the destination's
    largest key; of what is there it reads the key only, and it is right when
    the destination holds a key-order prefix. Without a destination, without
    keys, or with an empty source, the destination becomes exactly the source.

    With ``root`` the result lies in folders of the table there, and the table
    points to them once all are written; without it they lie in the shared
    folder and only the result names them. With ``rows_per_range`` the copy
    goes range by range in key order and records each in the ledger; if it
    fails, the next call with that ledger, run and mode goes on after the last
    recorded range. The source is read twice for that, whatever its order and however
    many ranges there are: it is sorted into files, and each range reads the few
    files that hold its keys, of the destination likewise.

    A table that was created with a record holds the source to it: left-out columns get their
    defaults, a NULL in a column that takes none ends the copy.

    Keys are never cleaned, so that a row keeps its key from run to run; the
    result says how many the rules would have changed.

    No folder is ever written twice: one left by a failed write is not among
    the returned locations, so nobody reads it. The verdict compares with the
    source as it is after the copy, without any tolerance where rows are missing though
    the source has not changed meanwhile; ``source_rows`` saves both counts where the
    source's own server has already given them.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    done = completed_locations(ledger, [spec])
    if done:
        return finished_copy(source.sparkSession, done[spec.table_key])
    return _copy(source, spec, run_ts, locations, mode, ledger, source_rows, root, rows_per_range)


class TableCopy:
    """One table's copy as a job: opened, written in ranges side by side, then finished.

    Ranges are recorded in the ledger in key order, each once all before it are
    there, so what an interrupted copy has recorded is always the beginning of the table.
    """

    def __init__(
        self, source: DataFrame, spec: TableSpec, run_ts: datetime, locations: Sequence[str], mode: str,
        ledger: Ledger | None, source_rows: int | None, root: str | None, rows_per_range: int | None,
    ):
        self.source, self.spec, self.run_ts, self.locations = source, spec, run_ts, tuple(locations)
        self.mode, self.ledger, self.source_rows = mode, ledger, source_rows
        self.root, self.rows_per_range = root, rows_per_range
        self.name, self.rows = spec.table_key, 0
        self.spark, self.keys = source.sparkSession, list(spec.keys)
        self.scratch: list[str] = []
        self.started = False
        self.lock = threading.Lock()

    def open(self) -> list[Piece]:
        """Find out what is there and what is missing; the ranges to write."""
        spark, spec, mode = self.spark, self.spec, self.mode
        before = unfinished(self.ledger, spec, mode)
        self.total = self.source.count() if self.source_rows is None else self.source_rows
        if self.ledger and not self.started:
            self.ledger.record(spec.table_key, "start", total_rows=self.total, message=mode)
        self.started = True
        self.path = table_path(self.root, spec) if self.root else fresh_path(spark, spec.table_key)
        self.there = self.locations or (current_folders(spark, self.path) if self.root else ())
        self.by_key = bool(self.there and self.keys and self.total)
        self.written, self.recorded, self.done, self.odd = [], 0, before.rows, 0
        self.folders = list(before.folders)
        if before.all_written:
            return []
        record = read_record(spark, self.path) if self.root else None
        source, replaced = self.source, None
        if record:
            source = conform_rows(source, record, self.run_ts)
        if self.by_key:
            dest = spark.read.parquet(*self.there)
            if mode == "resume":
                source = keyset_filter(source.select(*dest.columns), self.keys, mark_value(dest, self.keys))
                self.done = self.done or dest.count()
            else:
                replaced = dest
        # Keys are written as they are at the source, so the largest one written is the mark.
        after = mark_value(spark.read.parquet(*self.folders), self.keys) if self.folders else None
        parts = self._parts(source, replaced, after)
        self.written = [None] * len(parts)
        rows = max(1, self.total // len(parts))
        return [Piece(rows, partial(self._write, number, *part)) for number, part in enumerate(parts)]

    def _scratch(self) -> str:
        self.scratch.append(fresh_path(self.spark, f"{self.spec.table_key}-sorted"))
        return self.scratch[-1]

    def _parts(self, source: DataFrame, replaced: DataFrame | None, after: tuple | None) -> list[tuple]:
        """The ranges after a key, each with its last key, its source rows and those they replace."""
        keys, rows_per_range = self.keys, self.rows_per_range
        source = keyset_filter(source, keys, after)
        if not keys or not rows_per_range or self.total <= rows_per_range:
            return [(None, source, None if replaced is None else keyset_filter(replaced, keys, after))]
        files = file_count(self.total, -(-self.total // rows_per_range))
        try:
            arriving = sorted_zones(source, keys, self._scratch(), files)
        except PySparkException:
            # Some row cannot be read. The ranges before it are copied all the same, each read by itself.
            return _parts_one_by_one(source, replaced, keys, after, rows_per_range)
        ends, there = arriving.range_ends(rows_per_range), None
        if replaced is not None:
            there = zone_map(replaced, keys)
            there = clustered(there, ends, self._scratch(), file_count(there.rows, len(ends)))
        return [
            (upto, arriving.read(low, upto), None if there is None else there.read(low, upto))
            for low, upto in zip([after, *ends[:-1]], ends)
        ]

    def _write(self, number: int, upto: tuple | None, part: DataFrame, old: DataFrame | None) -> None:
        seen = Observation()
        measures = [F.count(F.lit(1)).alias("rows")]
        if self.keys:
            measures += [F.max(F.col(self.keys[0])).alias("mark"),
                         F.count_if(odd_key(part.schema, self.keys, self.run_ts)).alias("odd")]
        folder = new_folder(self.path, "range")
        rows_to_write(part, old, self.keys, self.run_ts).observe(seen, *measures).write.parquet(folder)
        with self.lock:
            self.written[number] = folder, seen.get, upto is None
            while self.recorded < len(self.written) and self.written[self.recorded]:
                self._record(*self.written[self.recorded])
                self.recorded += 1

    def _record(self, folder: str, seen: dict, last: bool) -> None:
        self.folders.append(folder)
        self.done += seen["rows"]
        self.odd += seen.get("odd", 0)
        if self.ledger:
            self.ledger.record(
                self.spec.table_key, "progress", last_id=whole_number(seen.get("mark")),
                processed_rows=self.done, message=folder + ("\nend" if last else ""),
            )

    def finish(self) -> CopyResult:
        """Point the table to its folders and compare the counts."""
        spark, spec = self.spark, self.spec
        placed = tuple(self.folders)
        if self.by_key and self.mode == "resume":
            placed = (*self.there, *placed)
        result = spark.read.parquet(*placed)
        copied = result.count()
        if self.root:
            publish(spark, self.path, placed)
        if self.ledger:
            self.ledger.record(spec.table_key, "complete", message="\n".join(placed))
        now = self.source.count() if self.source_rows is None else self.total
        lost = self.source_rows is None and now == self.total and copied < now
        counts = "table_name string, total_records bigint"
        verdict = count_check(
            spark.createDataFrame([(spec.table_key, now)], counts),
            spark.createDataFrame([(spec.table_key, copied)], counts),
            **({"floor": 0, "rate": 0.0} if lost else {}),
        )
        self._clear()
        return CopyResult(placed, result, copied, verdict, odd_keys=self.odd)

    def fail(self, error: Exception) -> None:
        self._clear()
        if self.ledger:
            self.ledger.record(self.spec.table_key, "error", message=str(error))

    def _clear(self) -> None:
        for path in self.scratch:
            remove_folder(self.spark, path)
        self.scratch.clear()


def _copy(*options) -> CopyResult:
    """A table by itself: its ranges one after the other, and nothing is tried twice."""
    job = TableCopy(*options)
    try:
        for piece in job.open():
            piece.run()
        return job.finish()
    except Exception as error:
        job.fail(error)
        raise


def _parts_one_by_one(
    source: DataFrame, replaced: DataFrame | None, keys: list[str], after: tuple | None,
    rows_per_range: int,
) -> list[tuple]:
    """The same ranges, found from the keys alone; every range is a pass over the source."""
    plan = batch_plan(source.select(*keys), keys, rows_per_range)
    lasts = plan.orderBy("batch_id").select(*[f"last_{k}" for k in keys]).collect()
    ends = [*(tuple(row) for row in lasts[:-1]), None]
    return [
        (upto, key_range(source, keys, low, upto),
         None if replaced is None else key_range(replaced, keys, low, upto))
        for low, upto in zip([after, *ends[:-1]], ends)
    ]


def copy_tables(
    spark: SparkSession,
    sources: Mapping[TableSpec, DataFrame],
    run_ts: datetime,
    locations: Mapping[TableSpec, Sequence[str]] | None = None,
    mode: str = "full",
    workers: int = 8,
    ledger: Ledger | None = None,
    root: str | None = None,
    rows_per_range: int | None = None,
    attempts: int = 3,
    wait: float = 1.0,
) -> tuple[DataFrame, dict[TableSpec, CopyResult]]:
    """Copy tables side by side; one that fails does not stop the others.

    Each table is a set of ordinary Spark jobs in its own fair pool, copied as
    by ``copy_table``. ``workers`` tables or ranges run at a time, those of the table
    that is expected to need longest first; what fails is tried ``attempts`` times, ``wait`` seconds
    and more apart. Returns a report with one row per table, and the results
    of those that succeeded.
    """
    locations = locations or {}
    specs = list(sources)
    if ledger:
        ledger.record(None, "set_totals", total_rows=len(specs))

    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    done = completed_locations(ledger, specs)

    waiting = [s for s in specs if s.table_key not in done]
    jobs = [
        TableCopy(sources[spec], spec, run_ts, locations.get(spec, ()), mode, ledger, None, root, rows_per_range)
        for spec in waiting
    ]
    for job in jobs:
        job.rows = guessed_rows(job.source)
    found = dict(zip(waiting, WorkQueue(spark, workers, attempts, wait).run(jobs)))
    outcomes = [
        found[s] if s in found else finished_copy(spark, done[s.table_key]) for s in specs
    ]
    if ledger:
        ledger.tidy()
    results: dict[TableSpec, CopyResult] = {}
    rows = []
    for index, (spec, outcome) in enumerate(zip(specs, outcomes), start=1):
        if isinstance(outcome, CopyResult):
            results[spec] = outcome
            rows.append((index, spec.schema, spec.name, outcome.rows,
                         "SKIPPED" if outcome.skipped else "COMPLETED", None))
        else:
            rows.append((index, spec.schema, spec.name, None, "FAILED", str(outcome)))
    report = spark.createDataFrame(
        rows,
        "index bigint, schema_name string, table_name string, rows bigint, "
        "status string, error string",
    )
    return report, results
