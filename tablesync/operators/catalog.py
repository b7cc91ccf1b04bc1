"""Inventory of schemas, tables, columns, indexes and keys of many servers.

The inputs have the shape of ``information_schema`` with a ``server`` column
in front. The lists built here (columns of a table, of an index, of a key) are
bounded by the servers' own limits on columns, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.types import spark_type

# Schemas that belong to the server itself.
SYSTEM_SCHEMAS = ("information_schema", "performance_schema", "mysql", "sys")
FALLBACK_KEY = "id"

TABLE = ["server", "table_schema", "table_name"]


def user_schemas(schemata: DataFrame, excluded: tuple[str, ...] = SYSTEM_SCHEMAS) -> DataFrame:
    """Schemas that are not the server's own."""
    return schemata.filter(~F.col("table_schema").isin(*excluded))


def base_tables(tables: DataFrame, excluded: tuple[str, ...] = SYSTEM_SCHEMAS) -> DataFrame:
    """Real tables (no views) of the user schemas."""
    return user_schemas(tables, excluded).filter(F.col("table_type") == "BASE TABLE")


def _of_tables(rows: DataFrame, tables: DataFrame) -> DataFrame:
    return rows.join(tables.select(*TABLE).distinct(), TABLE, "left_semi")


def _ordered_names(order: Column, name: Column) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), name.alias("n"))))
    return F.transform(pairs, lambda pair: pair["n"])


def catalog_columns(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """Columns of the given tables with their flags as booleans."""
    return _of_tables(columns, tables).select(
        *TABLE,
        "ordinal_position",
        "column_name",
        "column_type",
        (F.col("is_nullable") == "YES").alias("is_nullable"),
        "column_default",
        F.coalesce(F.col("extra") == "auto_increment", F.lit(False)).alias("is_auto_increment"),
        "character_set_name",
        "collation_name",
    )


def nested_columns(flat_columns: DataFrame) -> DataFrame:
    """One row per table with its columns as an ordered array of structs."""
    column = F.struct(
        "ordinal_position", "column_name", "column_type", "is_nullable", "is_auto_increment"
    )
    return flat_columns.groupBy(*TABLE).agg(F.array_sort(F.collect_list(column)).alias("columns"))


def table_schemas(columns: DataFrame) -> DataFrame:
    """One row per table with its columns as Spark DDL, from the servers' type texts.

    Columns that must not be NULL say so; defaults travel in the inventory.
    """
    name = F.concat(F.lit("`"), F.replace("column_name", F.lit("`"), F.lit("``")), F.lit("`"))
    strict = F.when(F.col("is_nullable") == "NO", " NOT NULL").otherwise("")
    part = F.concat(name, F.lit(" "), spark_type(F.col("column_type")), strict)
    return (
        columns.withColumn("part", part)
        .groupBy(*TABLE)
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.concat_ws(", ", _ordered_names(F.col("ordinal_position"), F.col("part"))).alias(
                "ddl"
            ),
        )
    )


def table_records(
    columns: DataFrame, key_usage: DataFrame | None = None, references: DataFrame | None = None
) -> DataFrame:
    """One row per table with its columns, primary key and references, as its record keeps them."""
    column = F.struct(
        "ordinal_position",
        F.col("column_name").alias("name"),
        spark_type(F.col("column_type")).alias("type"),
        F.coalesce(F.col("is_nullable") != "NO", F.lit(True)).alias("nullable"),
        F.col("column_default").alias("default_text"),
    )
    tables = columns.groupBy(*TABLE).agg(
        F.transform(F.array_sort(F.collect_list(column)), lambda c: c.dropFields("ordinal_position"))
        .alias("columns")
    )
    none = lambda kind: F.lit(None).cast(kind)
    if key_usage is None:
        tables = tables.withColumn("keys", none("array<string>"))
    else:
        keys = primary_keys(key_usage).withColumnRenamed("key_columns", "keys")
        tables = tables.join(keys, TABLE, "left")
    if references is None:
        return tables.withColumn("refers", none("array<struct<columns:array<string>,parent:string,"
                                                "parent_columns:array<string>>>"))
    parent = F.concat_ws(".", "referenced_table_schema", "referenced_table_name")
    single = (
        references.dropna(subset=["referenced_table_name"])
        .groupBy(*TABLE, "constraint_name", parent.alias("parent"))
        .agg(_ordered_names(F.col("ordinal_position"), F.col("column_name")).alias("columns"),
             _ordered_names(F.col("ordinal_position"), F.col("referenced_column_name")).alias("parent_columns"))
    )
    named = F.struct("constraint_name", "columns", "parent", "parent_columns")
    refers = single.groupBy(*TABLE).agg(
        F.transform(F.array_sort(F.collect_list(named)), lambda r: r.dropFields("constraint_name"))
        .alias("refers")
    )
    return tables.join(refers, TABLE, "left")


def index_groups(statistics: DataFrame) -> DataFrame:
    """One row per index with its columns in order."""
    return (
        statistics.groupBy(*TABLE, "index_name")
        .agg(
            _ordered_names(F.col("seq_in_index"), F.col("column_name")).alias("columns"),
            (F.min_by("non_unique", "seq_in_index") == 0).alias("is_unique"),
        )
        .withColumn("is_primary", F.col("index_name") == "PRIMARY")
    )


def primary_keys(key_usage: DataFrame) -> DataFrame:
    """Primary key columns of each table, in key order."""
    return (
        key_usage.filter(F.col("constraint_name") == "PRIMARY")
        .groupBy(*TABLE)
        .agg(_ordered_names(F.col("ordinal_position"), F.col("column_name")).alias("key_columns"))
    )


def first_key_column(tables: DataFrame, columns: DataFrame, key_usage: DataFrame) -> DataFrame:
    """The primary key column that comes first in the table, ``id`` where it has no key.

    First by its place in the table; the key itself may name it later.
    """
    of_key = key_usage.filter(F.col("constraint_name") == "PRIMARY").select(*TABLE, "column_name")
    leading = (
        columns.join(of_key, [*TABLE, "column_name"], "left_semi")
        .groupBy(*TABLE)
        .agg(F.min_by("column_name", "ordinal_position").alias("key_column"))
    )
    return (
        tables.select(*TABLE)
        .join(leading, TABLE, "left")
        .withColumn("key_column", F.coalesce("key_column", F.lit(FALLBACK_KEY)))
    )


def order_columns(tables: DataFrame, columns: DataFrame, key_usage: DataFrame) -> DataFrame:
    """What to sort a table by: its key, else its first column, else the constant 1."""
    first = columns.groupBy(*TABLE).agg(
        F.min_by("column_name", "ordinal_position").alias("first_column")
    )
    return (
        tables.select(*TABLE)
        .join(primary_keys(key_usage), TABLE, "left")
        .join(first, TABLE, "left")
        .select(
            *TABLE,
            F.coalesce(
                "key_columns",
                F.when(F.col("first_column").isNotNull(), F.array("first_column")),
                F.array(F.lit("1")),
            ).alias("order_columns"),
        )
    )


def catalog_counts(columns: DataFrame) -> DataFrame:
    """Schemas, tables and columns per table, schema, server and over all, by ``level``.

    The columns of a table are counted first and the tables of a schema next,
    so the rollup works on one row per schema however full each of them is.
    """
    counts = ["n_schemas", "n_tables", "n_columns"]
    one = F.lit(1).cast("bigint")
    per_table = columns.groupBy(*TABLE).agg(F.count(F.lit(1)).alias("n_columns"))
    per_schema = per_table.groupBy(*TABLE[:2]).agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("n_columns").alias("n_columns")
    )
    upper = (
        per_schema.rollup(*TABLE[:2])
        .agg(
            F.count(F.lit(1)).alias("n_schemas"),
            F.sum("n_tables").alias("n_tables"),
            F.sum("n_columns").alias("n_columns"),
            F.grouping_id().alias("gid"),
        )
        .select(
            F.when(F.col("gid") == 0, "schema").when(F.col("gid") == 1, "server")
            .otherwise("all").alias("level"),
            *TABLE[:2],
            F.lit(None).cast("string").alias("table_name"),
            *counts,
        )
    )
    tables = per_table.select(
        F.lit("table").alias("level"), *TABLE,
        one.alias("n_schemas"), one.alias("n_tables"), "n_columns",
    )
    return tables.unionByName(upper)


def parse_target(target: str) -> tuple[str, str | None]:
    """``schema`` or ``schema.table`` as a pair."""
    parts = target.split(".")
    if len(parts) > 2 or not all(parts):
        raise ValueError(f"target must be 'schema' or 'schema.table', got {target!r}")
    return parts[0], parts[1] if len(parts) == 2 else None


def select_targets(tables: DataFrame, target: str, check: bool = True) -> DataFrame:
    """The base tables a target names; an error when it names none."""
    schema, table = parse_target(target)
    found = base_tables(tables).filter(F.col("table_schema") == schema)
    if table is not None:
        found = found.filter(F.col("table_name") == table)
    if check and found.isEmpty():
        raise LookupError(f"no tables found for target {target!r}")
    return found


def missing_objects(
    source_tables: DataFrame,
    source_indexes: DataFrame,
    dest_tables: DataFrame,
    dest_indexes: DataFrame,
) -> DataFrame:
    """Schemas, tables and non-primary indexes of the source that the destination lacks.

    Both sides are inventories with server names of their own: objects are
    looked for by schema, table and index name, wherever at the destination,
    and reported with the source's server. Primary indexes come with their
    table and are left out.
    """
    schema_key = ["server", "table_schema"]
    index_key = TABLE + ["index_name"]
    in_dest = lambda key: [c for c in key if c != "server"]
    no_name = F.lit(None).cast("string")

    schemas = (
        source_tables.select(*schema_key)
        .distinct()
        .join(dest_tables.select(*in_dest(schema_key)).distinct(), in_dest(schema_key), "left_anti")
        .select(F.lit("schema").alias("kind"), *schema_key,
                no_name.alias("table_name"), no_name.alias("index_name"))
    )
    tables = (
        source_tables.select(*TABLE)
        .distinct()
        .join(dest_tables.select(*in_dest(TABLE)).distinct(), in_dest(TABLE), "left_anti")
        .select(F.lit("table").alias("kind"), *TABLE, no_name.alias("index_name"))
    )
    indexes = (
        source_indexes.filter(F.col("index_name") != "PRIMARY")
        .select(*index_key)
        .distinct()
        .join(dest_indexes.select(*in_dest(index_key)).distinct(), in_dest(index_key), "left_anti")
        .select(F.lit("index").alias("kind"), *index_key)
    )
    return schemas.unionByName(tables).unionByName(indexes)
