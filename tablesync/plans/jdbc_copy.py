"""Copying tables from one JDBC server to another."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.operators.catalog import (
    base_tables,
    catalog_columns,
    nested_columns,
    primary_keys,
)
from tablesync.operators.clean import sanitize_copied
from tablesync.operators.counts import whole_number
from tablesync.operators.keyed import replace_into
from tablesync.operators.paging import batch_plan
from tablesync.operators.reconcile import count_check
from tablesync.plans.copy import MODES, completed_locations
from tablesync.plans.side_by_side import side_by_side
from tablesync.session import scratch_space, stage
from tablesync.sources import inventory, jdbc
from tablesync.sources.call_log import CallLog
from tablesync.sources.ledger_store import Ledger

Result = TypeVar("Result")
COUNTS = "table_name string, total_records bigint"


@dataclass(frozen=True)
class Server:
    """A JDBC server and how many connections a job may open to it."""

    url: str
    connections: int = 16
    quote: str = "`"
    wait: float = 1.0
    log: CallLog | None = field(default=None, compare=False)

    def timed(self, kind: str, statement: str, call: Callable[[], Result]) -> Result:
        """What a call to the server gives, logged where there is a log."""
        return self.log.timed(self.url, kind, statement, call) if self.log else call()

    def one_row(self, spark: SparkSession, query: str) -> tuple:
        """One row of an answer; a lost connection is tried again, each attempt a call of its own."""
        ask = lambda: tuple(jdbc.read_jdbc(spark, jdbc.read_options(self.url, query)).first())
        return jdbc.patiently(lambda: self.timed("queryrow", query, ask), wait=self.wait)

    def execute(self, spark: SparkSession, statements: list[str]) -> None:
        self.timed("exec", "; ".join(statements), lambda: jdbc.execute(spark, self.url, statements))

    def write(self, rows: DataFrame, table: str) -> None:
        """Append rows to a table of the server over its connections."""
        options = jdbc.write_options(self.url, table, connections=self.connections)
        self.timed("exec", f"INSERT INTO {table}", lambda: jdbc.write_jdbc(rows, options, "append"))

    def count(self, spark: SparkSession, spec: TableSpec) -> int:
        return int(self.one_row(spark, jdbc.total_query(jdbc.table_name(spec, self.quote)))[0])

    def query(self, spec: TableSpec, columns: list[str], text_columns: tuple[str, ...] = ()) -> str:
        return jdbc.pushed_query(jdbc.table_name(spec, self.quote), columns, text_columns, self.quote)

    def names(self, spec: TableSpec) -> list[str]:
        return [jdbc.quoted(key, self.quote) for key in spec.keys]

    def keys(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        """The key columns only, in strides where the leading key is a number of any type."""
        query, stride = self.query(spec, list(spec.keys)), {}
        table = jdbc.table_name(spec, self.quote)
        bounds = tuple(map(whole_number, self.one_row(
            spark, jdbc.mark_query(table, spec.keys[0], self.quote))))
        if None not in bounds:
            stride = {"partition_column": spec.keys[0], "bounds": bounds,
                      "partitions": self.connections}
        return jdbc.read_jdbc(spark, jdbc.read_options(self.url, query, **stride))

    def plan(self, spark: SparkSession, spec: TableSpec, rows_per_range: int) -> list[tuple]:
        """The last keys of ranges of equally many rows, whatever the type and gaps of the key.

        Only keys are read. One row per range reaches the driver.
        """
        keys = list(spec.keys)
        plan = batch_plan(self.keys(spark, spec), keys, rows_per_range).orderBy("batch_id")
        return [tuple(row) for row in plan.select(*[f"last_{k}" for k in keys]).collect()]

    def rows(
        self, spark: SparkSession, spec: TableSpec, columns: list[str],
        text_columns: tuple[str, ...] = (), conditions: list[str] | None = None,
    ) -> DataFrame:
        """The table, one query and partition per condition."""
        query = self.query(spec, columns, text_columns)
        if not conditions:
            return jdbc.read_jdbc(spark, jdbc.read_options(self.url, query))
        options = jdbc.read_options(self.url, query)
        properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return jdbc.read_jdbc_ranges(spark, self.url, query, conditions, properties)


def copy_between(
    spark: SparkSession,
    source: Server,
    dest: Server,
    spec: TableSpec,
    columns: list[str],
    run_ts: datetime,
    mode: str = "full",
    text_columns: tuple[str, ...] = (),
    ledger: Ledger | None = None,
    rows_per_range: int = 1_000_000,
    referenced: bool = False,
) -> DataFrame:
    """Copy a table; returns the verdict on its counts, taken after the copy.

    ``resume`` walks the source range by range in key order and appends the
    rows whose keys the destination lacks, so what a failed range left behind
    is neither lost nor doubled; ranges that the ledger has recorded are not
    looked at again. A range is read over as many connections as its server allows.
    ``full`` reads the source once into the shared folder,
    works out the replaced table, and loads it beside the live table, which is
    swapped by renaming once all is there. A table without a key is loaded
    beside and swapped in either mode. A table that takes part in foreign keys (``referenced``) keeps
    its name, and so its own and others' references: its rows are replaced in one transaction.
    Keys are not cleaned. Calls go into the servers' logs, which are written when the copy ends.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if ledger:
        ledger.record(spec.table_key, "start", total_rows=source.count(spark, spec), message=mode)
    try:
        with scratch_space(spark):
            if mode == "resume" and spec.keys:
                _append_ranges(spark, source, dest, spec, columns, run_ts, text_columns, ledger,
                               rows_per_range)
            else:
                _load_beside(spark, source, dest, spec, columns, run_ts, text_columns, rows_per_range,
                             referenced)
        total, copied = source.count(spark, spec), dest.count(spark, spec)
    except Exception as error:
        if ledger:
            ledger.record(spec.table_key, "error", message=str(error))
        raise
    finally:
        for log in {id(s.log): s.log for s in (source, dest) if s.log}.values():
            log.flush()
    if ledger:
        ledger.record(spec.table_key, "complete", message=dest.url)
    return count_check(
        spark.createDataFrame([(spec.table_key, total)], COUNTS),
        spark.createDataFrame([(spec.table_key, copied)], COUNTS),
    )


def _ranges(
    spark: SparkSession, source: Server, spec: TableSpec, rows_per_range: int
) -> list[list[tuple[tuple | None, tuple | None]]]:
    """Ranges that are recorded one by one, each as the parts that are read side by side."""
    rows_per_part = max(1, rows_per_range // source.connections)
    ends = [None, *source.plan(spark, spec, rows_per_part)[:-1], None]
    parts, many = list(zip(ends, ends[1:])), rows_per_range // rows_per_part
    return [parts[at:at + many] for at in range(0, len(parts), many)]


def _append_ranges(
    spark: SparkSession, source: Server, dest: Server, spec: TableSpec, columns: list[str],
    run_ts: datetime, text_columns: tuple[str, ...], ledger: Ledger | None, rows_per_range: int,
) -> None:
    keys = list(spec.keys)
    live = jdbc.table_name(spec, dest.quote)
    recorded = _recorded_ranges(ledger, spec)
    done = dest.count(spark, spec)
    for parts in _ranges(spark, source, spec, rows_per_range):
        upto = parts[-1][1]
        name = f"{parts[0][0]!r} {upto!r}"
        if upto is not None and name in recorded:
            continue
        there = dest.rows(
            spark, spec, keys, conditions=[jdbc.key_range(dest.names(spec), *part) for part in parts]
        )
        arriving = source.rows(
            spark, spec, columns, text_columns,
            [jdbc.key_range(source.names(spec), *part) for part in parts],
        )
        same = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
        # Staged before it is written: the destination is not read while it changes.
        lacking = arriving.alias("a").join(there.alias("b"), same, "left_anti")
        missing = source.timed("query", f"{source.query(spec, columns)} {name}", lambda: stage(lacking, "missing"))
        dest.write(sanitize_copied(missing, run_ts, keys), live)
        done += missing.count()
        if ledger:
            last = None if upto is None else whole_number(upto[0])
            ledger.record(spec.table_key, "progress", last_id=last, processed_rows=done, message=name)


def _recorded_ranges(ledger: Ledger | None, spec: TableSpec) -> set[str]:
    """The ranges that this run has written; one short row each."""
    if ledger is None:
        return set()
    own = (F.col("table_key") == spec.table_key) & (F.col("op") == "progress")
    return {row["message"] for row in ledger.events().filter(own).select("message").collect()}


def _load_beside(
    spark: SparkSession, source: Server, dest: Server, spec: TableSpec, columns: list[str],
    run_ts: datetime, text_columns: tuple[str, ...], rows_per_range: int, referenced: bool = False,
) -> None:
    keys, conditions = list(spec.keys), None
    if keys:
        conditions = jdbc.range_predicates(
            source.names(spec), source.plan(spark, spec, rows_per_range))
    arriving = source.rows(spark, spec, columns, text_columns, conditions)
    cleaned = sanitize_copied(arriving, run_ts, keys)
    rows = source.timed("query", source.query(spec, columns), lambda: stage(cleaned, spec.table_key))
    if keys and not rows.isEmpty():
        # Where the destination has the same ranges, they read it evenly; the ends are open.
        if conditions:
            conditions = jdbc.range_predicates(
                dest.names(spec), [tuple(r) for r in _last_keys(rows, keys, rows_per_range)])
        there = dest.rows(spark, spec, columns, text_columns, conditions)
        rows = dest.timed(
            "query", dest.query(spec, columns),
            lambda: stage(replace_into(there, rows, keys), spec.table_key),
        )
    live = jdbc.table_name(spec, dest.quote)
    beside, old = (
        jdbc.table_name(TableSpec(spec.schema, spec.name + end), dest.quote)
        for end in ("__copy", "__old")
    )
    dest.execute(spark, [
        f"DROP TABLE IF EXISTS {beside}", f"DROP TABLE IF EXISTS {old}",
        f"CREATE TABLE {beside} LIKE {live}",
    ])
    dest.write(rows, beside)
    if referenced:
        # Renaming would take others' foreign keys along to the old table; here every row is there
        # again when the transaction ends. A stop before that undoes it.
        names = ", ".join(jdbc.quoted(c, dest.quote) for c in columns)
        dest.execute(spark, [
            "SET FOREIGN_KEY_CHECKS = 0", "START TRANSACTION", f"DELETE FROM {live}",
            f"INSERT INTO {live} ({names}) SELECT {names} FROM {beside}", "COMMIT",
            "SET FOREIGN_KEY_CHECKS = 1", f"DROP TABLE {beside}",
        ])
        return
    dest.execute(spark, [
        f"RENAME TABLE {live} TO {old}, {beside} TO {live}", f"DROP TABLE {old}",
    ])


def _last_keys(rows: DataFrame, keys: list[str], rows_per_range: int) -> list:
    plan = batch_plan(rows.select(*keys), keys, rows_per_range).orderBy("batch_id")
    return plan.select(*[f"last_{k}" for k in keys]).collect()


def copy_all_between(
    spark: SparkSession,
    source: Server,
    dest: Server,
    tables: Mapping[TableSpec, list[str]],
    run_ts: datetime,
    ledger: Ledger,
    workers: int = 8,
    references: Collection[TableSpec] = (),
    **options,
) -> DataFrame:
    """Copy tables side by side; one that fails does not stop the others.

    ``tables`` gives the columns of each, ``options`` are those of
    ``copy_between``; ``references`` names the tables that take part in foreign keys. Tables that the ledger's run has completed are skipped.
    Returns one row per table with its verdict, or why there is none.
    """
    specs = list(tables)
    ledger.record(None, "set_totals", total_rows=len(specs))
    done = completed_locations(ledger, specs)

    def copy_one(spec: TableSpec):
        if spec.table_key in done:
            return None
        return copy_between(spark, source, dest, spec, tables[spec], run_ts, ledger=ledger,
                            referenced=spec in references, **options).first()

    outcomes = side_by_side(spark, copy_one, specs, workers, lambda spec: spec.table_key)
    ledger.tidy()
    rows = []
    for spec, outcome in zip(specs, outcomes):
        if outcome is None:
            rows.append((spec.table_key, None, None, "SKIPPED", None))
        elif isinstance(outcome, Exception):
            rows.append((spec.table_key, None, None, "FAILED", str(outcome)))
        else:
            rows.append((spec.table_key, outcome["src_rows"], outcome["dest_rows"],
                         outcome["verdict"], None))
    return spark.createDataFrame(
        rows, "table_name string, src_rows bigint, dest_rows bigint, status string, error string"
    )


def server_tables(
    spark: SparkSession, name: str, server: Server
) -> tuple[DataFrame, dict[TableSpec, list[str]], tuple[str, ...]]:
    """What a server's own inventory says: its columns, its tables with their column names, and
    the names of columns that hold dates or times, which are fetched as text.

    One row per table reaches the driver.
    """
    frame = lambda kind: inventory.read_frame(spark, kind, {name: server.url})
    tables = base_tables(frame("tables"))
    columns = catalog_columns(frame("columns"), tables)
    keys = primary_keys(frame("key_column_usage"))
    rows = nested_columns(columns).join(keys, ["server", "table_schema", "table_name"], "left").collect()
    found, dated = {}, set()
    for row in rows:
        spec = TableSpec(row["table_schema"], row["table_name"], tuple(row["key_columns"] or ()))
        found[spec] = [column["column_name"] for column in row["columns"]]
        dated |= {c["column_name"] for c in row["columns"]
                  if c["column_type"].lower().startswith(("date", "timestamp"))}
    return columns, found, tuple(sorted(dated))


def migrate_server(
    spark: SparkSession, source: Server, dest: Server, run_ts: datetime, ledger: Ledger, **options
) -> DataFrame:
    """Copy every base table of a server, as its own inventory lists them, to another one.

    The destination's tables must be there; those that are not come out as
    FAILED. ``options`` are those of ``copy_all_between``.
    """
    _, tables, dated = server_tables(spark, "source", source)
    return copy_all_between(
        spark, source, dest, tables, run_ts, ledger, text_columns=dated, **options
    )
