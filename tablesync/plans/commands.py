"""The jobs a user asks for by name: discover, replicate, migrate, users, full, progress."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tablesync.model import TableSpec
from tablesync.operators.access import (
    access_summary,
    all_statements,
    dangling_statements,
    portable_accounts,
)
from tablesync.operators.catalog import (
    base_tables,
    catalog_columns,
    catalog_counts,
    parse_target,
)
from tablesync.operators.reconcile import progress_report, progress_totals
from tablesync.plans.copy import MODES, CopyResult, copy_tables, unfinished
from tablesync.plans.side_by_side import side_by_side
from tablesync.plans.structure import ensure_tables
from tablesync.sources.ledger_store import Ledger
from tablesync.sources.versions import FORMER_SECONDS, remove_former, table_path


def discover(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Table and column counts of the user schemas."""
    return catalog_counts(catalog_columns(columns, base_tables(tables)))


def replicate(
    spark: SparkSession, sources: Mapping[TableSpec, DataFrame], root: str, target: str | None = None
) -> DataFrame:
    """Create the empty destination tables of a target, or of everything."""
    return ensure_tables(spark, choose(sources, target), root)


def migrate(
    spark: SparkSession,
    sources: Mapping[TableSpec, DataFrame],
    run_ts: datetime,
    target: str | None = None,
    ledger: Ledger | None = None,
    **options,
) -> tuple[DataFrame, dict[TableSpec, CopyResult]]:
    """Copy the tables of a target, or all of them; ``options`` are those of ``copy_tables``.

    A run that goes on first counts its tables again and enters what has changed.
    """
    chosen = choose(sources, target)
    if ledger:
        preflight(chosen, ledger)
    return copy_tables(spark, chosen, run_ts, ledger=ledger, **options)


def preflight(sources: Mapping[TableSpec, DataFrame], ledger: Ledger) -> DataFrame:
    """The tables that the run knows with their counts of then and now, which go into the run."""
    counts = readable_counts({s.table_key: df for s, df in sources.items()})
    known = counts.dropna().withColumnRenamed("table_name", "table_key")
    return ledger.recount(known)


def full(
    spark: SparkSession,
    sources: Mapping[TableSpec, DataFrame],
    root: str,
    run_ts: datetime,
    target: str | None = None,
    ledger: Ledger | None = None,
    workers: int = 8,
    rows_per_range: int | None = None,
) -> tuple[DataFrame, dict[TableSpec, CopyResult]]:
    """Create the destination tables below ``root``, then fill them there by key."""
    chosen = choose(sources, target)
    replicate(spark, chosen, root)
    return migrate(
        spark, chosen, run_ts, workers=workers, ledger=ledger, root=root,
        rows_per_range=rows_per_range,
    )


def progress(
    sources: Mapping[TableSpec, DataFrame], destinations: Mapping[TableSpec, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Progress per table and over all; a table that cannot be counted is an ``Error``."""
    report = progress_report(
        readable_counts({s.table_key: df for s, df in sources.items()}),
        readable_counts({s.table_key: df for s, df in destinations.items()}),
    )
    return report, progress_totals(report)


def readable_counts(tables: Mapping[str, DataFrame], workers: int = 8) -> DataFrame:
    """One row per table with its row count, NULL where counting failed.

    Each table is counted by a job of its own, so one that cannot be read stops
    no other, and no plan grows with their number.
    """
    if not tables:
        raise ValueError("no tables to count")
    spark = next(iter(tables.values())).sparkSession
    found = side_by_side(spark, lambda name: tables[name].count(), tables, workers)
    rows = [(n, None if isinstance(c, Exception) else c) for n, c in zip(tables, found)]
    return spark.createDataFrame(rows, "table_name string, total_records bigint")


def clean_up(
    spark: SparkSession, specs: Iterable[TableSpec], root: str, ledger: Ledger | None = None,
    keep_seconds: float = FORMER_SECONDS, workers: int = 8,
) -> DataFrame:
    """Delete former folders of tables below ``root``; one row per table with their number.

    Ranges that an unfinished copy of the ledger's run has written stay, however old they are. A
    table that cannot be cleaned has an error and stops no other.
    """
    def clean(spec: TableSpec) -> int:
        kept = [f for mode in MODES for f in unfinished(ledger, spec, mode).folders]
        return len(remove_former(spark, table_path(root, spec), keep_seconds, kept))

    listed = list(specs)
    found = side_by_side(spark, clean, listed, workers, lambda spec: spec.table_key)
    rows = [(s.schema, s.name, *((None, str(n)) if isinstance(n, Exception) else (n, None)))
            for s, n in zip(listed, found)]
    return spark.createDataFrame(
        rows, "schema_name string, table_name string, removed bigint, error string")


def users(
    accounts: DataFrame, global_grants: DataFrame, db_grants: DataFrame, set_grants: DataFrame
) -> dict[str, DataFrame]:
    """What a copy of accounts and privileges would carry over, and what would fail."""
    return {
        "accounts": portable_accounts(accounts),
        "statements": all_statements(global_grants, db_grants, set_grants),
        "dangling": dangling_statements(accounts, global_grants, db_grants, set_grants),
        "summary": access_summary(accounts, global_grants, db_grants, set_grants),
    }


def choose(
    sources: Mapping[TableSpec, DataFrame], target: str | None
) -> dict[TableSpec, DataFrame]:
    """The tables a target names; an error when it names none."""
    if target is None:
        return dict(sources)
    schema, table = parse_target(target)
    chosen = {
        s: df for s, df in sources.items() if s.schema == schema and table in (None, s.name)
    }
    if not chosen:
        raise LookupError(f"no tables found for target {target!r}")
    return chosen
