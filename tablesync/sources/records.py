"""What a table asks of its rows, kept beside its pointer: columns, defaults, keys, references."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T

from tablesync.sources.zones import folder_exists

RECORD = (
    "columns array<struct<name:string,type:string,nullable:boolean,default_text:string>>, "
    "keys array<string>, "
    "refers array<struct<columns:array<string>,parent:string,parent_columns:array<string>>>"
)


@dataclass(frozen=True)
class ColumnRule:
    """A column: its Spark type as DDL, whether it may be NULL, and its default as the inventory's text."""

    name: str
    type: str
    nullable: bool = True
    default_text: str | None = None

    @property
    def may_be_left_out(self) -> bool:
        return self.nullable or self.default_text not in (None, "NULL")


@dataclass(frozen=True)
class Reference:
    """Columns whose values must be there in columns of the ``parent`` table (``schema.name``)."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableRecord:
    columns: tuple[ColumnRule, ...]
    keys: tuple[str, ...] = ()
    refers: tuple[Reference, ...] = ()

    @property
    def schema(self) -> T.StructType:
        """The columns as a schema; a default is the field's metadata ``default``."""
        return T.StructType([
            T.StructField(c.name, T.DataType.fromDDL(c.type), c.nullable,
                          {} if c.default_text is None else {"default": c.default_text})
            for c in self.columns
        ])

    @property
    def parents(self) -> set[str]:
        return {reference.parent for reference in self.refers}


def record_of(schema: T.StructType, keys: tuple[str, ...] = ()) -> TableRecord:
    """The record of a schema, with defaults from the fields' metadata."""
    columns = [ColumnRule(f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("default"))
               for f in schema]
    return TableRecord(tuple(columns), tuple(keys))


def record_from_row(row: Row) -> TableRecord:
    """The record in a row that has the fields of ``RECORD``."""
    return TableRecord(
        tuple(ColumnRule(c["name"], c["type"], c["nullable"], c["default_text"]) for c in row["columns"]),
        tuple(row["keys"] or ()),
        tuple(Reference(tuple(r["columns"]), r["parent"], tuple(r["parent_columns"]))
              for r in row["refers"] or ()),
    )


def read_record(spark: SparkSession, path: str) -> TableRecord | None:
    """The record of the table at ``path``; none for a table that was not created with one."""
    if not folder_exists(spark, f"{path}/record"):
        return None
    reader = spark.read.schema(RECORD).option("recursiveFileLookup", "true")
    row = reader.parquet(f"{path}/record").first()
    return record_from_row(row) if row else None


def write_record(spark: SparkSession, path: str, record: TableRecord) -> None:
    """Keep the record of a table. It is written once, before the table is there for readers."""
    row = (
        [(c.name, c.type, c.nullable, c.default_text) for c in record.columns],
        list(record.keys),
        [(list(r.columns), r.parent, list(r.parent_columns)) for r in record.refers],
    )
    one = spark.createDataFrame([row], RECORD).coalesce(1)
    one.write.parquet(f"{path}/record/{uuid.uuid4().hex}")
