"""Creating destination tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.operators.catalog import table_records
from tablesync.plans.side_by_side import side_by_side
from tablesync.sources.records import TableRecord, read_record, record_from_row, record_of, write_record
from tablesync.sources.versions import current_folders, new_folder, publish, table_path


def creation_rounds(parents: Mapping[str, set[str]]) -> list[list[str]]:
    """Tables in rounds, each after the tables it refers to, given every table's parents.

    A table's reference to itself, or to a table that is not created here, does
    not wait. Of tables that refer to each other in a circle, the first by name
    goes first.
    """
    waiting = {name: {p for p in own if p in parents and p != name} for name, own in parents.items()}

    def above(name: str) -> set[str]:
        found, left = set(), [name]
        while left:
            new = waiting.get(left.pop(), set()) - found
            found |= new
            left += new
        return found

    rounds = []
    while waiting:
        free = sorted(name for name, own in waiting.items() if not own & waiting.keys())
        free = free or [min(name for name in waiting if name in above(name))]
        rounds.append(free)
        for name in free:
            del waiting[name]
        waiting = {name: own & waiting.keys() for name, own in waiting.items()}
    return rounds


def ensure_tables(
    spark: SparkSession, sources: Mapping[TableSpec, DataFrame], root: str, workers: int = 8,
    records: Mapping[TableSpec, TableRecord] | None = None,
) -> DataFrame:
    """Create an empty table below ``root`` for each source that has none yet.

    Each table keeps a record beside its pointer: column names and types, which columns
    must not be NULL, defaults, the key and references. Copies and merges into
    the table hold rows to it (``conform_rows``). Without ``records`` it comes from the
    source's schema, defaults from the fields' metadata ``default``. A table is
    created after those it refers to. Running it again changes nothing. Returns
    one row per table.
    """
    records = records or {}
    own = {spec: records.get(spec) or record_of(df.schema, spec.keys) for spec, df in sources.items()}

    def create(spec: TableSpec) -> bool:
        path = table_path(root, spec)
        if current_folders(spark, path):
            return False
        if read_record(spark, path) is None:
            write_record(spark, path, own[spec])
        folder = new_folder(path)
        sources[spec].limit(0).write.parquet(folder)
        publish(spark, path, [folder])
        return True

    specs = list(sources)
    by_key = {spec.table_key: spec for spec in specs}
    created: dict[TableSpec, bool] = {}
    for names in creation_rounds({spec.table_key: own[spec].parents for spec in specs}):
        ready = [by_key[name] for name in names]
        for spec, outcome in zip(ready, side_by_side(spark, create, ready, workers, lambda s: s.table_key)):
            if isinstance(outcome, Exception):
                raise outcome
            created[spec] = outcome
    rows = [
        (spec.schema, spec.name, len(own[spec].columns), created[spec]) for spec in specs
    ]
    return spark.createDataFrame(
        rows, "schema_name string, table_name string, n_columns bigint, created boolean"
    )


def ensure_catalog_tables(
    spark: SparkSession, columns: DataFrame, root: str, workers: int = 8,
    key_usage: DataFrame | None = None, references: DataFrame | None = None,
) -> DataFrame:
    """The same from a column inventory; each server's tables lie below ``root/server``.

    ``key_usage`` and ``references`` are the inventory's frames of keys and foreign keys; with them
    the records name both. One row per table reaches the driver, where tables are created. The report
    names the server too.
    """
    records: dict[str, dict[TableSpec, TableRecord]] = {}
    for row in table_records(columns, key_usage, references).collect():
        record = record_from_row(row)
        spec = TableSpec(row["table_schema"], row["table_name"], record.keys)
        records.setdefault(row["server"], {})[spec] = record
    empty = lambda own: {spec: spark.createDataFrame([], record.schema) for spec, record in own.items()}
    reports = [
        ensure_tables(spark, empty(own), f"{root.rstrip('/')}/{server}", workers, own)
        .select(F.lit(server).alias("server"), "*")
        for server, own in sorted(records.items())
    ]
    if not reports:
        return spark.createDataFrame([], "server string, schema_name string, table_name string, "
                                         "n_columns bigint, created boolean")
    return reduce(DataFrame.unionByName, reports)
